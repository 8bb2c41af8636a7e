"""Reconciliation that finds the rows: order-free digests in a small tree.

Each layer writes one digest per (part, key bucket): the number of rows, and the sum and the
exclusive or of the rows' hashes, none of which depends on order or layout.  Two layers are
compared from the top: parts first (date and run), then buckets of parts that differ, then the
rows of buckets that differ.  Equal data is never joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rows import all_of

BUCKETS = 256
_SUMS = ("n", "total", "parity")


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's values; a null is a value of its own, in its own place."""
    cells = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(*cells)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit("bucket")), F.lit(buckets)).cast("int")


def digest_leaves(
    df: DataFrame, parts: Sequence[str], keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """``parts, bucket, n, total, parity`` of a layer, in one pass with partial aggregates.

    Layers are comparable if ``keys``, ``columns`` and ``buckets`` are the same and the columns
    have the same types.  Store it beside the layer, as it is built from what is written anyway.
    """
    rows = df.select(*parts, _bucket(keys, buckets).alias("bucket"), row_hash([*keys, *columns]).alias("h"))
    return rows.groupBy(*parts, "bucket").agg(*_folded("h"))


def _folded(h: str) -> list[Column]:
    total = F.sum(F.col(h).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n"), total.alias("total"), F.bit_xor(h).alias("parity")]


def _above(leaves: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Digests of whole parts, from those of their buckets."""
    return leaves.groupBy(*parts).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("parity").alias("parity"))


def _differing(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Where two digests of the same level differ: ``on, rows_left, rows_right``."""
    a, b = left.alias("a"), right.alias("b")
    met = a.join(b, all_of([F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]), "full_outer")
    same = all_of([F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _SUMS])
    here = F.col("a.n").isNotNull()
    return met.filter(~same).select(
        *[F.when(here, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in on],
        F.coalesce("a.n", F.lit(0)).alias("rows_left"),
        F.coalesce("b.n", F.lit(0)).alias("rows_right"),
    )


def differing_parts(left: DataFrame, right: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Parts (dates, runs) whose digests differ, with the rows of both layers."""
    return _differing(_above(left, parts), _above(right, parts), parts)


def differing_buckets(left: DataFrame, right: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Buckets that differ, looked for only in parts that do."""
    found = differing_parts(left, right, parts).select(*[F.col(p).alias(f"__{p}") for p in parts])
    inside = all_of([F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts])
    left, right = (d.join(found, inside, "left_semi") for d in (left, right))
    return _differing(left, right, [*parts, "bucket"])


def differing_rows(
    left: DataFrame,
    right: DataFrame,
    buckets_found: DataFrame,
    parts: Sequence[str],
    keys: Sequence[str],
    columns: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """``parts, keys, kind, changed``: rows ``missing`` on the right, ``extra`` there, or ``changed``
    with the names of their differing columns.

    Only rows of the buckets found are shuffled; the others are dropped where they are read.
    Keys are unique within a part of a layer and not null.
    """
    found = buckets_found.select(*[F.col(c).alias(f"__{c}") for c in [*parts, "bucket"]])
    inside = all_of([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*parts, "bucket"]])

    def rows(df: DataFrame) -> DataFrame:
        marked = df.select(*parts, *keys, *columns, _bucket(keys, buckets).alias("bucket"))
        return marked.join(found, inside, "left_semi").drop("bucket")

    a, b = rows(left).withColumn("__in", F.lit(True)).alias("a"), rows(right).withColumn("__in", F.lit(True)).alias("b")
    on = [*parts, *keys]
    met = a.join(b, all_of([F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]), "full_outer")
    in_a, in_b = F.col("a.__in").isNotNull(), F.col("b.__in").isNotNull()
    other = [F.when(~F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")), F.lit(c)) for c in columns]
    changed = F.array_join(F.array(*other), ",")
    kind = F.when(~in_b, "missing").when(~in_a, "extra").when(changed != "", "changed")
    return (
        met.select(
            *[F.when(in_a, F.col(f"a.`{c}`")).otherwise(F.col(f"b.`{c}`")).alias(c) for c in on],
            kind.alias("kind"),
            F.when(in_a & in_b, changed).alias("changed"),
        )
        .filter("kind is not null")
    )
