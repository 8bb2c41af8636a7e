"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.grams import batches, char_cells
from tidemark.llm.scratch import free_name

_LETTER = regex.compile(r"\p{L}")
#: Cells of the count table that travel in one row.
_SLICE = 4096


@dataclass(frozen=True)
class LanguageModel:
    """``log_prob[cell, language]`` and the log share of each language."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray
    orders: tuple[int, ...]
    bits: int


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    key_col: str = "doc_id",
    orders: tuple[int, ...] = (1, 2, 3),
    bits: int = 15,
    per_language: int = 8_000,
    smoothing: float = 0.5,
    max_matrix_mb: int = 256,
) -> LanguageModel:
    """Count n-grams by language.

    Learns from about ``per_language`` texts of each language, those with the smallest hashes
    of their key, so the share of a language in the table does not matter and training costs
    the same at every size.  Rows without text or language are left out.  The matrix has
    ``2**bits`` rows and a column for each language; a table with so many languages that it
    would pass ``max_matrix_mb`` is an error.  With no rows to learn from, the model has no
    language and predicts ``und`` only.
    """
    rows = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(key_col).alias("key")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    most = max_matrix_mb * (1 << 20) // (4 << bits)
    sizes = rows.groupBy("lang").count().limit(most + 1)  # more languages than that are an error
    languages = sorted((r["lang"], r["count"]) for r in sizes.collect())
    if len(languages) > most:
        raise ValueError(f"over {most} languages need a matrix over {max_matrix_mb} MB: use fewer bits")
    names = [lang for lang, _ in languages]
    if not names:
        return LanguageModel([], np.zeros(0), np.zeros((1 << bits, 0), np.float32), orders, bits)
    # A row is learned from if its hash, as a share of all hashes, is below bound / rows.
    share = (F.pmod(F.xxhash64("key"), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("share")
    sample = (
        rows.join(F.broadcast(sizes), "lang")  # a row for each language, checked above
        .filter(share * F.col("count") < per_language)
        .select("lang", "text")
    )
    # A task's table is as large as the model, so the tasks follow the bounded sample.
    learned = sum(min(n, per_language) for _, n in languages)
    sample = sample.repartition(-(-learned // 2_000))
    place = {lang: i for i, lang in enumerate(names)}

    def count(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One dense table for each task: languages x cells, sent on in slices.
        table = np.zeros((len(place), 1 << bits), np.int64)
        for batch in batches_in:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            order = sorted(range(len(texts)), key=lambda i: langs[i])
            texts, langs = [texts[i].lower() for i in order], [langs[i] for i in order]
            for a, b in batches([t.encode("utf-8", "surrogatepass") for t in texts]):
                cells, starts = char_cells(texts[a:b], orders, bits)
                ends = [*starts[1:].tolist(), len(cells)]
                at = 0
                for i in range(a, b):
                    if i + 1 == b or langs[i + 1] != langs[i]:
                        part = cells[at : ends[i - a]].ravel()
                        table[place[langs[i]]] += np.bincount(part, minlength=1 << bits)
                        at = ends[i - a]
        width = min(_SLICE, 1 << bits)
        for i, row in enumerate(table):
            if row.any():
                parts = [row[s : s + width].tolist() for s in range(0, len(row), width)]
                yield pa.RecordBatch.from_pydict(
                    {"lang_no": [i] * len(parts), "slice_no": list(range(len(parts))), "counts": parts},
                    schema=pa.schema([("lang_no", pa.int32()), ("slice_no", pa.int32()), ("counts", pa.list_(pa.int64()))]),
                )

    parts = sample.mapInArrow(count, "lang_no int, slice_no int, counts array<bigint>")
    summed = (
        parts.select("lang_no", "slice_no", F.posexplode("counts"))
        .groupBy("lang_no", "slice_no", "pos")
        .agg(F.sum("col").alias("n"))
    ).toArrow()  # at most languages x 2**bits rows, checked above
    table = np.zeros((len(names), 1 << bits))
    cell = summed["slice_no"].to_numpy() * min(_SLICE, 1 << bits) + summed["pos"].to_numpy()
    table[summed["lang_no"].to_numpy(), cell] = summed["n"].to_numpy()
    smooth = table + smoothing
    log_prob = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
    # The sample is even over languages, and so is the prior.
    return LanguageModel(names, np.full(len(names), -np.log(len(names))), np.ascontiguousarray(log_prob), orders, bits)


def predict(
    docs: DataFrame,
    model: LanguageModel,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    pred_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """Columns ``carry``, ``pred_col`` and ``score_col`` for every row.

    Null texts and texts without a letter are ``und`` with score 0.  Of languages with equal
    posterior the first by code point wins.  The model is sent to the executors once
    (``spark.sparkContext.broadcast``); its size is bounded by ``train``.
    """
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    rows = docs.select(*carried, F.col(text_col).alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    step = max(1 << 15, (1 << 22) // max(1, len(model.languages)))

    def score(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches_in:
            column = batch.column("text").to_pylist()
            texts = [t.lower() if t and m.languages and _LETTER.search(t) else None for t in column]
            known = [i for i, t in enumerate(texts) if t is not None]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            plain = [texts[i] for i in known]
            for a, b in batches([t.encode("utf-8", "surrogatepass") for t in plain], step):
                sums = _log_sums(m, plain[a:b], step)
                top = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i, best, p in zip(known[a:b], top.tolist(), share.tolist()):
                    langs[i], scores[i] = m.languages[best], p
            arrays = [batch.column(f.name) for f in kept] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*[f.name for f in kept], "lang_pred", "score"])

    out = rows.select(*[f.name for f in kept], "text").mapInArrow(
        score, ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], "lang_pred string, score double"])
    )
    return out.select(
        *[F.col(f.name).alias(c) for f, c in zip(kept, carry)],
        F.col("lang_pred").alias(pred_col), F.col("score").alias(score_col),
    )


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has no language: null texts, and texts without a letter.

    A model that knows no language tells none, and the letters alone decide.
    """
    if not model.languages:
        model = replace(model, languages=[""], log_prior=np.zeros(1), log_prob=np.zeros((1 << model.bits, 1), np.float32))
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    told = predict(docs, model, text_col, tuple(docs.columns), pred, score)
    return told.filter(F.col(pred) != "und").select(*[F.col(f"`{c}`") for c in docs.columns])


def _log_sums(m: LanguageModel, texts: list[str], step: int) -> np.ndarray:
    """Log joint probability (texts, languages); one long text is summed piece by piece."""
    cells, starts = char_cells(texts, m.orders, m.bits)
    sums = np.zeros((len(texts), len(m.languages)))
    for a in range(0, len(cells), step):
        b = min(a + step, len(cells))
        first = np.searchsorted(starts, a, side="right") - 1
        last = np.searchsorted(starts, b, side="left")
        cuts = np.maximum(starts[first:last], a) - a
        for order in range(len(m.orders)):
            sums[first:last] += np.add.reduceat(m.log_prob[cells[a:b, order]], cuts, axis=0, dtype=np.float64)
    return sums + m.log_prior
