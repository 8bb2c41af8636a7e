"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates and scored as sparse dot products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.grams import Tokens, batches, mix

_SALT = [np.uint64(x) for x in (0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9E6C63D0676A9A99)]


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    bits: int


def features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells (tokens, 4) of each token's n-grams, and the text each token belongs to.

    Word unigram and bigram, the trigram of word shapes (kind, capitals, length class), and
    the shape with whether the next word is the same.  Marks are words of their own.  An
    n-gram does not reach into the next text.
    """
    t = Tokens(texts)
    n = t.hashes.size
    cells = np.empty((n, 4), np.uint32)
    if not n:
        return cells, t.doc
    down = np.uint64(64 - bits)
    nxt, shape = np.zeros(n, np.uint64), t.shape.astype(np.uint64)
    joined = t.doc[1:] == t.doc[:-1]
    nxt[:-1] = np.where(joined, t.hashes[1:], 0)
    shape1, shape2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    shape1[:-1] = np.where(joined, shape[1:], 0)
    shape2[:-2] = np.where(t.doc[2:] == t.doc[:-2], shape[2:], 0)
    cells[:, 0] = t.hashes >> down
    cells[:, 1] = mix(t.hashes * _SALT[0] + nxt) >> down
    cells[:, 2] = mix((shape * np.uint64(256) + shape1) * np.uint64(256) + shape2 + _SALT[1]) >> down
    cells[:, 3] = mix(shape * np.uint64(2) + (nxt == t.hashes) + _SALT[2]) >> down
    return cells, t.doc


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    bits: int,
    epochs: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
) -> np.ndarray:
    """Weights (``2**bits`` cells and the bias last) after ``epochs`` passes over the examples."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weight(i):
        zi = z[i]
        return np.where(
            np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2)
        )

    for _ in range(epochs):
        for cells, values, label in examples:
            w = weight(cells)
            margin = float(np.clip(w @ values, -35, 35))
            g = (1 / (1 + np.exp(-margin)) - label) * values
            step = (np.sqrt(n[cells] + g * g) - np.sqrt(n[cells])) / alpha
            z[cells] += g - step * w
            n[cells] += g * g
    return weight(np.arange((1 << bits) + 1))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bits: int = 18,
    sample_rows: int = 24_000,
    shards: int = 12,
    epochs: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.5,
) -> QualityModel:
    """Train on about ``sample_rows`` labelled documents, those with the smallest key hashes.

    The sample is cut into ``shards``; each learns by itself in a task and the weights are
    averaged, weighted by rows (parameter mixing).  Of several labels of one document the
    highest counts; null labels and keys are left out, a null text is an empty one.  Without
    any labelled row all weights are 0, so every score is one half.
    """
    wanted = (
        labels.select(F.col(key_col).alias("key"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("key").isNotNull() & F.col("label").isNotNull())
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    total = wanted.count()
    if not total:
        return QualityModel(np.zeros(1 << bits, np.float32), 0.0, bits)
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # Bounded by sample_rows, so small enough to send to every executor.
    sample = F.broadcast(wanted.filter(share < sample_rows / total))
    rows = (
        docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
        .join(sample, "key")
        .select(
            F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(shards)).cast("int").alias("shard"),
            F.xxhash64(F.lit(11), "key").alias("turn"),
            F.coalesce("text", F.lit("")).alias("text"),
            (F.col("label") > 0).cast("int").alias("label"),
        )
    )

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("turn")
        texts = [t.encode("utf-8", "surrogatepass") for t in table["text"].to_pylist()]
        labels_, examples = table["label"].to_pylist(), []
        for a, b in batches(texts):
            cells, doc = features(texts[a:b], bits)
            cuts = np.searchsorted(doc, np.arange(b - a + 1))
            for i in range(b - a):
                own, times = np.unique(cells[cuts[i] : cuts[i + 1]].ravel(), return_counts=True)
                scale = 1 / np.sqrt(max(1, cuts[i + 1] - cuts[i]))
                examples.append(
                    (np.append(own, 1 << bits).astype(np.int64), np.append(times * scale, 1.0), labels_[a + i])
                )
        w = ftrl(examples, bits, epochs, alpha, beta, l1, l2).astype(np.float32)
        return pa.table({"n": pa.array([len(examples)], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})

    parts = rows.groupBy("shard").applyInArrow(learn, "n bigint, w binary").collect()  # one row a shard
    seen = sum(r["n"] for r in parts)
    w = np.zeros((1 << bits) + 1)
    for r in sorted(parts, key=lambda r: bytes(r["w"])):
        w += np.frombuffer(r["w"], np.float32) * (r["n"] / seen)
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]), bits)


def score(
    docs: DataFrame, model: QualityModel, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``key_col`` and ``score`` (0 to 1) of every row; null and empty texts score by the bias.

    Each batch of texts is a sparse matrix of n-gram counts, multiplied by the weights as a
    gather and a sum over each text.
    """
    rows = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches_in:
            texts = [
                t.encode("utf-8", "surrogatepass") if t else b"" for t in batch.column("text").to_pylist()
            ]
            margins = np.zeros(len(texts))
            for a, b in batches(texts):
                cells, doc = features(texts[a:b], m.bits)
                size = np.bincount(doc, minlength=b - a)
                sums = np.bincount(doc, m.weights[cells].sum(axis=1, dtype=np.float64), b - a)
                margins[a:b] = sums / np.sqrt(np.maximum(size, 1))
            p = 1 / (1 + np.exp(-np.clip(margins + m.bias, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(p)], ["key", "score"])

    return rows.mapInArrow(run, f"key {kind}, score double").select(F.col("key").alias(key_col), "score")
