"""From raw documents to packed sequences: language, copies, near copies, mixture, packing.

Every stage takes an empty table (and gives one), nulls in any column, repeated rows, long texts,
and further columns whatever their names; all but the last give back the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, langid, mixing, packing, simhash
from tidemark.llm.scratch import small_batches, stored
from tidemark.session import tune


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that have a language; those without any letter, and null texts, go.

    Where no row tells a language there is none to learn, and the letters alone decide.
    """
    small_batches(tune(spark))
    return langid.keep_identified(docs, langid.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts: the longest, then the smallest id."""
    small_batches(tune(spark))
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near-equal fingerprints: the smallest id."""
    small_batches(tune(spark))
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target asks, none to twice."""
    small_batches(tune(spark))
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    small_batches(tune(spark))
    # Workers of long pipelines share their executor with a grown heap: they remember fewer words.
    return packing.pack(docs, remember=150_000)


STAGES = [
    ("language", identify_language),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models and fingerprints cannot be written in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder, each one's result stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = stored(docs, f"stage-{name.replace(' ', '-')}")
    return docs
