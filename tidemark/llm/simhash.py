"""SimHash near-dedup with a pivot distance table.

The table holds the Hamming distances of a fingerprint to many reference fingerprints.  By the
triangle inequality no coordinate of two fingerprints that are ``radius`` bits apart differs by
more than ``radius``, so a pair with a larger coordinate difference is discarded unseen; the
others are verified.

So that not every pair has to be looked at, some references form a ladder: reference ``j`` has
its lowest ``2 j`` bits set.  The step from one rung to the next tells how many bits two places
have, and two fingerprints that differ in at most two bits differ in at most two steps.  Of four
groups of steps two are therefore equal, which is an equality join.  Keys that very many
fingerprints share are refined with the steps that are still free, again four groups at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import addressed, quoted, stored, without_rows

STEPS = 32
#: Reference fingerprints: the ladder, and as many drawn at random (fixed seed).
LADDER = np.array([(1 << 2 * j) - 1 for j in range(STEPS + 1)], np.uint64)
SCATTERED = np.random.default_rng(64).integers(0, 1 << 64, 24, dtype=np.uint64, endpoint=False)


def distances(fingerprints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Rows of the pivot table."""
    return np.bitwise_count(fingerprints[:, None] ^ references[None, :]).astype(np.int8)


def ladder_steps(fingerprints: np.ndarray) -> np.ndarray:
    """The steps between rungs of each row, two bits a step, packed into one integer.

    From rung to rung a distance falls by one for each set bit of the two places and rises by
    one for each that is not.
    """
    fall = -np.diff(distances(fingerprints, LADDER), axis=1)
    packed = ((fall + 2) // 2).astype(np.uint64) << (2 * np.arange(STEPS, dtype=np.uint64))
    return np.bitwise_or.reduce(packed, axis=1)


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, hashes.size, 1 << 14):
        bits = np.unpackbits(hashes[a : a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > hashes.size, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, handle: str | None = None
) -> DataFrame:
    """``id, fp`` of every row, ``fp`` as a signed 64-bit integer; after them its ``row``, if the rows have a ``handle``."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([F.col(handle).alias("row")] if handle else [])
    )
    carry = ["row"] if handle else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(values.view(np.int64)), *(batch.column(c) for c in carry)], ["id", "fp", *carry]
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, ", ".join([f"id {kinds['id']}, fp bigint", *(f"{c} {kinds[c]}" for c in carry)]))


# -- candidate keys ---------------------------------------------------------------------------


def _level(free: list[int]) -> list[tuple[int, list[int]]]:
    """The ways to fix two of four groups of the free steps: mask of fixed places, steps left."""
    groups = [free[i * len(free) // 4 : (i + 1) * len(free) // 4] for i in range(4)]
    out = []
    for a, b in combinations(range(4), 2):
        fixed = [*groups[a], *groups[b]]
        mask = sum(3 << 2 * step for step in fixed)
        out.append((mask, [s for s in free if s not in fixed]))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class _Forest:
    """Union-find over the rows of one batch."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.root[a] != self.root[b]
        while apart.any():
            a, b = a[apart], b[apart]
            high, low = np.maximum(self.root[a], self.root[b]), np.minimum(self.root[a], self.root[b])
            self.root[high] = low  # of several for one row any will do; the rest come in the next round
            self.settle()
            apart = self.root[a] != self.root[b]

    def settle(self) -> None:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return
            self.root = up


def _near(fp: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no reference tells apart and whose fingerprints are within the radius."""
    for r in range(table.shape[1]):
        if not a.size:
            return a, b
        keep = np.abs(table[a, r] - table[b, r]) <= radius
        a, b = a[keep], b[keep]
    keep = np.bitwise_count(fp[a] ^ fp[b]) <= radius
    return a[keep], b[keep]


def _link_runs(run_of: np.ndarray, fp: np.ndarray, radius: int, brute: int) -> np.ndarray:
    """Root row of each row, linking rows of one run whose fingerprints are within the radius."""
    forest, table, n = _Forest(fp.size), distances(fp, SCATTERED), fp.size
    sizes = np.bincount(run_of)
    small = sizes[run_of] <= brute
    for shift in range(1, min(brute, int(sizes.max(initial=0)))):
        a = np.flatnonzero((run_of[: n - shift] == run_of[shift:]) & small[: n - shift])
        if not a.size:
            break
        forest.join(*_near(fp, table, a, a + shift, radius))
    for run in np.flatnonzero(sizes > brute):
        # A run too large for pairs: look up all fingerprints within the radius of each.
        rows = np.flatnonzero(run_of == run)
        rows = rows[np.argsort(fp[rows])]
        ordered = fp[rows]
        for flips in range(1, radius + 1):
            for places in combinations(range(64), flips):
                other = ordered ^ np.uint64(sum(1 << p for p in places))
                at = np.minimum(np.searchsorted(ordered, other), rows.size - 1)
                hit = ordered[at] == other
                forest.join(rows[hit], rows[at[hit]])
    return forest.root


def _linker(radius: int, brute: int):
    """Arrow function: links within each key of rows sorted by ``path, key``, as a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)
        for batch in batches:
            fresh = np.stack([batch.column(c).to_numpy() for c in ("path", "key", "fp")])
            rows = np.concatenate([held, fresh], axis=1)
            new = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(axis=0)) + 1
            if not new.size:
                held = rows
                continue
            done, held = rows[:, : new[-1]], rows[:, new[-1] :]
            yield edges(done)
        if held.shape[1]:
            yield edges(held)

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        start = np.append(False, (np.diff(rows[:2], axis=1) != 0).any(axis=0))
        root = _link_runs(np.cumsum(start), rows[2].view(np.uint64), radius, brute)
        linked = root != np.arange(root.size)
        return pa.RecordBatch.from_arrays([pa.array(rows[2][linked]), pa.array(rows[2][root[linked]])], ["a", "b"])

    return run


def near_links(distinct_fp: DataFrame, radius: int = 2, largest: int = 2_000) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp``; linked sets are exactly those that
    links of at most ``radius`` (1 or 2) differing bits make.

    A key held by more than ``largest`` fingerprints is refined instead of compared, so no task
    gets a large group; after four levels all but two steps are fixed, and what is still larger
    is looked up neighbour by neighbour.
    """
    if radius not in (1, 2):
        raise ValueError("the ladder serves a radius of 1 or 2")

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            packed = ladder_steps(fp.view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(packed)], ["fp", "steps"])

    rows = stored(distinct_fp.select("fp").mapInArrow(steps, "fp bigint, steps bigint"), "pivot-table")
    rows = rows.select("fp", "steps", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("fixed"))
    ways = {0: list(range(STEPS))}  # path: steps that are still free
    found = []
    for depth in range(4):
        last = depth == 3
        table = [
            (path, path * 8 + i + 1, mask, left)
            for path, free in ways.items()
            for i, (mask, left) in enumerate(_level(free))
        ]
        ways = {deeper: left for _, deeper, _, left in table}
        options = F.create_map(
            *[
                x
                for path in dict.fromkeys(t[0] for t in table)
                for x in (
                    F.lit(path).cast("long"),
                    F.array(
                        *[
                            F.struct(F.lit(t[1]).cast("long").alias("path"), F.lit(_signed(t[2])).cast("long").alias("mask"))
                            for t in table
                            if t[0] == path
                        ]
                    ),
                )
            ]
        )
        keyed = rows.select("fp", "steps", "fixed", F.explode(options[F.col("path")]).alias("way")).select(
            "fp", "steps", F.col("way.path").alias("path"), F.col("fixed").bitwiseOR(F.col("way.mask")).alias("fixed"),
        ).withColumn("key", F.col("steps").bitwiseAND(F.col("fixed")))
        groups = stored(
            keyed.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "pivot-keys"
        )
        fit = groups if last else groups.filter(F.col("n") <= largest)
        found.append(
            keyed.join(fit.select("path", "key"), ["path", "key"])
            .select("path", "key", "fp")
            .repartition("path", "key")
            .sortWithinPartitions("path", "key", "fp")
            .mapInArrow(_linker(radius, largest), "a bigint, b bigint")
        )
        hot = groups.filter(F.col("n") > largest).select("path", "key")
        if last or hot.isEmpty():
            break
        rows = stored(keyed.join(hot, ["path", "key"]).select("fp", "steps", "path", "fixed"), "pivot-hot")
        live = {r["path"] for r in rows.select("path").distinct().collect()}  # 6**depth at most
        ways = {path: left for path, left in ways.items() if path in live}
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """``id_col, fingerprint, component_id`` of every row.

    Texts lower-cased in A-Z, words split at ``[\\x20\\x09-\\x0D]``; a text with fewer words than
    a shingle is one shingle, one without words (null too) has fingerprint 0.  Fingerprints link
    at ``radius`` or fewer differing bits; the component id is the smallest id reachable.  Equal
    texts share a fingerprint and are compared once.  Null ids never name a component unless all
    its rows have none; repeated rows get equal results.
    """
    marked, named = _named(fingerprints(docs, id_col, text_col, words), radius)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "component").select(F.col("fp").alias("of"), "component_id")
    return marked.join(by_fp, F.col("fp") == F.col("of")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _named(prints: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and ``fp, least, component`` of each different one: its
    smallest id and the fingerprint that stands for its component."""
    marked = stored(prints, "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-ids")
    linked = components(near_links(distinct, radius))
    named = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    return marked, stored(named, "fingerprint-components")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, a null id last; of rows that
    share it any one."""
    rows, handle = addressed(docs, "simhash-rows")
    marked, named = _named(fingerprints(rows, id_col, text_col, words, handle), radius)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    # By fingerprint first: a row for each different one is joined, and no hot group.
    by_fp = marked.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n"))
    again = F.min("first").alias("first"), F.sum("n").alias("n")
    several = by_fp.join(named.select("fp", "component"), "fp").groupBy("component").agg(*again).filter("n > 1")
    stays = stored(
        named.join(several, "component").select(F.col("fp").alias("of"), F.col("first.row").alias("stays")), "simhash-stays"
    )
    gone = stored(
        marked.join(stays, F.col("fp") == F.col("of")).filter("row <> stays").select(F.col("row").alias(handle)),
        "simhash-gone",
    )
    return without_rows(rows, handle, gone).select(*quoted(docs.columns))
