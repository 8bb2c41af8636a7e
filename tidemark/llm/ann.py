"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.scratch import stored

#: Bits of a substring; its value is the key of a bucket.
SUB_BITS = 16
_MASKS = np.arange(1 << SUB_BITS, dtype=np.uint16)
_ORDER = np.argsort(np.bitwise_count(_MASKS), kind="stable").astype(np.uint16)
_UP_TO = np.searchsorted(np.bitwise_count(_MASKS)[_ORDER], np.arange(SUB_BITS + 1), side="right")


@dataclass(frozen=True)
class Coder:
    """``rotation`` (bits, dimensions) gives a code as the signs of a rotated vector; codes are
    searched within ``radius`` differing bits."""

    rotation: np.ndarray
    center: np.ndarray
    radius: int

    @property
    def substrings(self) -> int:
        return self.rotation.shape[0] // SUB_BITS

    def code(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings (vectors, substrings) of the codes."""
        bits = (vectors - self.center) @ self.rotation.T > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)

    def sub_radius(self, place: int) -> int:
        """Codes within the radius are within this of each other in at least one substring.

        Of m substrings, radius = a m + b: were b + 1 of them further than a apart and the
        others further than a - 1, the codes would differ in more than the radius.
        """
        a, b = divmod(self.radius, self.substrings)
        return a if place <= b else a - 1


def fit(
    sample: np.ndarray, k: int, bits: int, seed: int = 7, rounds: int = 30, coverage: float = 0.97, queries: int = 256
) -> Coder:
    """Learn rotations on a sample and the radius that holds its nearest neighbours.

    Each block of as many bits as dimensions is a rotation of its own, alternately fitted to
    the signs it produces (orthogonal Procrustes).  The radius is the ``coverage`` quantile of
    the code distances between sample vectors and their ``k`` nearest by inner product.
    """
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    center = sample.mean(axis=0)
    centred = sample - center
    blocks = []
    for _ in range(-(-bits // dims)):
        rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        for _ in range(rounds):
            signs = np.where(centred @ rotation.T > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ centred)
            rotation = left @ right
        blocks.append(rotation)
    made = Coder(np.concatenate(blocks)[:bits], center, bits)
    if sample.shape[0] < 2:
        return made
    # Drawn over the whole sample, which may be laid out by cluster, source or time.
    asked = rng.choice(sample.shape[0], min(queries, sample.shape[0]), replace=False)
    nearness = sample[asked] @ sample.T
    nearness[np.arange(asked.size), asked] = -np.inf
    k = min(k, sample.shape[0] - 1)
    nearest = np.argpartition(-nearness, k - 1, axis=1)[:, :k]
    codes = made.code(sample)
    apart = np.bitwise_count(codes[asked][:, None, :] ^ codes[nearest]).sum(axis=2)
    return Coder(made.rotation, center, int(np.quantile(apart, coverage, method="higher")))


def exact_products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the dimensions."""
    total = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        total += query[d] * vectors[:, d]
    return total


def _probe(query_sub: int, radius: int, starts: np.ndarray) -> np.ndarray:
    """Positions, in bucket order, of all entries whose substring is within ``radius``."""
    if radius < 0:
        return np.zeros(0, np.int64)
    buckets = _ORDER[: _UP_TO[min(radius, SUB_BITS)]] ^ np.uint16(query_sub)
    first, counts = starts[buckets], starts[buckets.astype(np.int64) + 1] - starts[buckets]
    held = counts > 0
    first, counts = first[held], counts[held]
    if not first.size:
        return np.zeros(0, np.int64)
    jumps = np.ones(counts.sum(), np.int64)
    ends = np.cumsum(counts)
    jumps[0] = first[0]
    jumps[ends[:-1]] = first[1:] - first[:-1] - counts[:-1] + 1
    return np.cumsum(jumps)


def _search(coder: Coder, place: int, data: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of each query among the entries found through substring ``place``.

    Entries that an earlier substring finds as well are left to it.  Scores from matrix
    products pick a few more than ``k``, whose exact scores decide.
    """
    ids = data["rep"].to_numpy()
    vectors = np.stack(data["vector"].to_numpy()).astype(np.float64)
    codes = coder.code(vectors)
    order = np.argsort(codes[:, place], kind="stable")
    table = order, np.searchsorted(codes[order, place], np.arange((1 << SUB_BITS) + 1))
    out_query, out_rep, out_score = [], [], []
    questions = np.stack(asked["vector"].to_numpy()).astype(np.float64)
    asked_codes = coder.code(questions)
    for q, vector, code in zip(asked["query"].to_numpy(), questions, asked_codes):
        order, starts = table
        found = order[_probe(int(code[place]), coder.sub_radius(place), starts)]
        apart = np.bitwise_count(codes[found] ^ code)
        keep = apart.sum(axis=1) <= coder.radius
        for earlier in range(place):  # found there already
            keep &= apart[:, earlier] > coder.sub_radius(earlier)
        found = found[keep]
        if not found.size:
            continue
        if found.size > k + 16:
            rough = vectors[found] @ vector
            found = found[np.argpartition(-rough, k + 15)[: k + 16]]
        scores = exact_products(vector, vectors[found])
        best = np.lexsort((ids[found], -scores))[:k]
        out_query += [q] * best.size
        out_rep += ids[found[best]].tolist()
        out_score += scores[best].tolist()
    return pd.DataFrame({"query": out_query, "rep": out_rep, "score": out_score})


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, each once.

    Out are rows without id, and vectors that are null, zero, or hold a null or a value that is
    not finite; so are vectors whose length is not the most frequent one.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.filter(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", finite)
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if lengths:
        rows = rows.filter(F.size("vector") == lengths[0]["n"])
    return rows.dropDuplicates(["vec_id", "vector"])


def _candidates(index: DataFrame, queries: DataFrame, coder: Coder, k: int, cell_rows: int, part_rows: int) -> DataFrame:
    """``query, rep, score``: of each query the ``k`` nearest found in each cell of the index.

    A cell is a substring with the same leading bits; queries go to the cells that hold buckets
    within the substring's radius, and no others.  A cell with more rows than ``cell_rows``, or
    more queries than ``part_rows``, is cut into parts that meet each other.
    """
    spark = index.sparkSession
    n_index = index.count()
    lead = int(np.clip(np.ceil(np.log2(max(1, n_index / cell_rows))), 3, SUB_BITS))
    sent = spark.sparkContext.broadcast(coder)
    size = 1 << lead
    near = [
        [[c for c in range(size) if bin(c ^ own).count("1") <= coder.sub_radius(p)] for own in range(size)]
        for p in range(coder.substrings)
    ] if lead <= 8 else None

    def cells(batches: Iterator[pd.DataFrame], routed: bool) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            codes = sent.value.code(np.stack(batch["vector"].to_numpy()).astype(np.float64))
            own = (codes >> (SUB_BITS - lead)).astype(np.int64)
            for place in range(codes.shape[1]):
                if not routed:
                    yield batch.assign(place=place, cell=own[:, place])
                elif near is not None:
                    yield batch.assign(place=place, cell=[near[place][c] for c in own[:, place]]).explode("cell").dropna(subset=["cell"]).astype({"cell": "int64"})
                else:
                    steps = _ORDER[: _UP_TO[max(0, min(sent.value.sub_radius(place), SUB_BITS))]].astype(np.int64)
                    steps = steps[steps < size]
                    goes = np.repeat(np.arange(len(batch)), steps.size)
                    yield batch.iloc[goes].assign(place=place, cell=(own[:, [place]] ^ steps).ravel())

    kind = index.schema["vector"].dataType.simpleString()
    entries = index.mapInPandas(lambda b: cells(b, False), f"rep bigint, vector {kind}, place int, cell bigint")
    probes = queries.mapInPandas(lambda b: cells(b, True), f"query bigint, vector {kind}, place int, cell bigint")
    where = ["place", "cell"]
    loads = entries.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / cell_rows).alias("chunks"))
    parts = probes.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("parts"))
    plan = stored(loads.join(parts, where).select(*where, "chunks", "parts"), "ann-cells")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    entries = entries.join(plan, where).select(
        "rep", "vector", *where, F.pmod(F.xxhash64("rep"), F.col("chunks")).alias("chunk"), spread("parts").alias("part")
    )
    probes = probes.join(plan, where).select(
        "query", "vector", *where, spread("chunks").alias("chunk"), F.pmod(F.xxhash64("query"), F.col("parts")).alias("part")
    )
    keys = ["place", "cell", "chunk", "part"]

    def search(key: tuple, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if data.empty or asked.empty:
            return pd.DataFrame({"query": [], "rep": [], "score": []})
        return _search(sent.value, int(key[0]), data, asked, k)

    return entries.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInPandas(
        search, "query bigint, rep bigint, score double"
    )


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
    bits: int = 64,
    sample_rows: int = 20_000,
    cell_rows: int = 20_000,
    part_rows: int = 4_096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every row whose id is
    divisible by ``every``, by inner product, ties to the smaller id, without the query's row.

    Rotations and radius are learned on about ``sample_rows`` vectors, those with the smallest
    id hashes; all rows are indexed.  Equal vectors are indexed and searched once, by their
    smallest id, and listed by their ids again at the end.  Every code within the radius is
    found and ranked by its floats.  A query for which fewer than ``k`` rows are within the
    radius is searched again with the radius of a whole code, so it gets all there are.  Which
    rows take part is told by ``usable``; an empty table gives no rows.
    """
    rows = stored(usable(vectors, id_col, vector_col), "ann-vectors")
    classes = stored(
        rows.groupBy("vector").agg(F.min("vec_id").alias("rep")).select("rep", "vector"), "ann-classes"
    )
    n = classes.count()
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = classes.filter(share < sample_rows / max(n, 1)).orderBy(F.xxhash64("rep"), "rep").toPandas()["vector"]  # bounded sample
    if not len(sample):
        sample = classes.orderBy("rep").limit(1).toPandas()["vector"]
    found_none = "query_id bigint, rank int, vec_id bigint, score double"
    if not len(sample):
        return vectors.sparkSession.createDataFrame([], found_none)
    coder = fit(np.stack(sample.to_numpy()).astype(np.float64), k, bits)

    of = rows.join(classes, "vector").select("vec_id", "rep")
    members = stored(
        of.select("*", F.row_number().over(Window.partitionBy("rep").orderBy("vec_id")).alias("n"))
        .filter(F.col("n") <= k + 1)
        .drop("n"),
        "ann-members",
    )
    asked = stored(of.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")), "ann-queries")
    queries = classes.join(asked.select(F.col("query").alias("rep")).distinct(), "rep").select(F.col("rep").alias("query"), "vector")

    def listed(found: DataFrame) -> DataFrame:
        """The k + 1 first rows of each searched vector: with its own row out, k are left."""
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        few = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
        best = found.select("*", F.row_number().over(few).alias("n")).filter(F.col("n") <= k + 1).drop("n")
        return (
            best.join(members, "rep")
            .select("query", "vec_id", "score", F.row_number().over(order).alias("n"))
            .filter(F.col("n") <= k + 1)
        )

    first = stored(listed(_candidates(classes, queries, coder, k + 1, cell_rows, part_rows)), "ann-found")
    enough = first.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k).select("query")
    again = stored(queries.join(enough, "query", "left_anti"), "ann-again")
    out = first
    if not again.isEmpty():
        whole = Coder(coder.rotation, coder.center, bits)
        wide = listed(_candidates(classes, again, whole, k + 1, cell_rows, part_rows))
        out = first.join(again.select("query"), "query", "left_anti").unionByName(wide)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(out, "query")
        .filter(F.col("query_id") != F.col("vec_id"))
        .select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
        .filter(F.col("rank") <= k)
    )
