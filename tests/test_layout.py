"""Interleaved layout, judged by the row groups that statistics leave out."""

from pathlib import Path

import pyarrow.parquet as pq
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.incremental import write_by_month
from tidemark.operators.layout import interleaved, rank_bounds, rank_of, z_ordered


def read_share(folder, column, value):
    """Share of row groups whose range holds ``value``."""
    hit = total = 0
    for file in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += s.min <= value <= s.max
    return hit / total, total


def table(spark):
    n = 200_000
    return spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.floor(F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0, 3) * 5000).cast("long").alias("b"),
        F.repeat(F.md5(F.col("id").cast("string")), 4).alias("c"),
    )


def test_both_columns_skip_most_row_groups(spark, tmp_path):
    df = table(spark)
    options = {"parquet.block.size": str(128 << 10), "parquet.page.row.count.limit": "1000"}
    z_ordered(df, ["a", "b"]).write.options(**options).parquet(f"{tmp_path}/z")
    df.repartitionByRange("a", "b").sortWithinPartitions("a", "b").write.options(**options).parquet(f"{tmp_path}/s")
    for column in ("a", "b"):
        share, total = read_share(f"{tmp_path}/z", column, 500)
        assert total > 60 and share < 0.3, (column, share, total)
    assert read_share(f"{tmp_path}/s", "b", 500)[0] > 0.8  # what a plain sort leaves to the second column
    assert spark.read.parquet(f"{tmp_path}/z").agg(F.sum(F.hash("*"))).first() == df.agg(F.sum(F.hash("*"))).first()


def test_ranks_and_bits(spark):
    values = [None, 1, 1, 2, 5, 5, 9]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    bounds = [2, 5, 7]
    got = rows(df.select("v", rank_of(F.col("v"), bounds).alias("r")))
    assert got == sorted([(v, sum(v >= b for b in bounds) if v is not None else 0) for v in values], key=repr)
    assert rank_bounds(df, ["v"], 1)["v"] in ([2], [5], [1])
    pairs = spark.createDataFrame([(0b101, 0b011)], "x int, y int")
    assert pairs.select(interleaved([F.col("x"), F.col("y")], 3)).first()[0] == 0b10_01_11


def test_marts_by_month_can_be_interleaved(spark, tmp_path):
    df = table(spark).withColumn("date_key", F.lit(20240101) + (F.col("a") % 3) * 100)
    write_by_month(df, f"{tmp_path}/m", ("a", "b"), date_col="date_key", interleave=True)
    back = spark.read.parquet(f"{tmp_path}/m")
    assert back.count() == 200_000 and rows(back.select("yyyymm").distinct()) == [(202401,), (202402,), (202403,)]
