"""Row-level building blocks: dedupe, rank, as-of, split, alignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def any_of(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def all_of(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark plans the ``row_number() = 1`` filter as a partial group limit before the
    shuffle and a final one after it, so each task ships at most one row per key and
    a hot key never lands whole on one task.  Give an order that leaves no ties.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def tie_break(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """The remaining orderable columns, ascending with nulls first, as a full tie-break."""
    return [
        F.col(f"`{f.name}`").asc()
        for f in df.schema.fields
        if f.name not in used and f.dataType.typeName() not in ("map", "variant")
    ]


def one_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Lookup side with one row per key (smallest value), so a join cannot fan out."""
    return (
        df.filter(all_of([F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.min(value).alias(value))
    )


#: Bands of a value for each doubling of it.
_BANDS = 64


def value_band(value: Column) -> Column:
    """A whole number that rises with a numeric value, some thousands in all; null for null.

    Values of different bands are ordered by their bands.
    """
    v = value.cast("double")
    band = F.signum(v) * F.floor(F.least(F.log2(F.abs(v) + 1) * _BANDS, F.lit(1e5)))
    return F.when(F.isnan(v), 1_000_000).otherwise(F.when(~F.isnan(v), band)).cast("long")


def rank_within(
    df: DataFrame, partition: Sequence[str], value: str, name: str = "rank"
) -> DataFrame:
    """Descending ``rank()`` of a numeric ``value`` inside ``partition``.

    Rows are first reduced to one row per distinct value with its count.  That histogram is
    ordered inside bands of the value only, and the bands' sums, a few thousand in a partition,
    tell how many rows are above each band.  The ranks are joined back on (partition, value).  A
    partition holding a third of all rows, all of different values, is thus spread over its
    bands, where a plain ``rank()`` would sort it in one task.
    """
    keys = list(partition)
    histogram = df.groupBy(*keys, value_band(F.col(value)).alias("__band"), value).agg(F.count(F.lit(1)).alias("__n"))
    before = lambda by, order: (
        Window.partitionBy(*by).orderBy(F.col(order).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    )
    bands = histogram.groupBy(*keys, "__band").agg(F.sum("__n").alias("__n"))
    above = bands.select(
        *[F.col(c).alias(f"__{c}") for c in keys],
        F.col("__band").alias("__of"),
        F.coalesce(F.sum("__n").over(before(keys, "__band")), F.lit(0)).alias("__above"),
    )
    inside = histogram.withColumn("__inside", F.coalesce(F.sum("__n").over(before([*keys, "__band"], value)), F.lit(0)))
    met = all_of([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys] + [F.col("__band").eqNullSafe(F.col("__of"))])
    ranks = inside.join(above, met).select(
        *[F.col(c).alias(f"__{c}") for c in (*keys, value)],
        (F.col("__above") + F.col("__inside") + 1).cast("int").alias(name),
    )
    on = all_of([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*keys, value)])
    return df.join(ranks, on, "inner").drop(*[f"__{c}" for c in (*keys, value)])


def next_time_after(
    events: DataFrame,
    candidates: DataFrame,
    key: str,
    event_time: str,
    candidate_time: str,
    name: str,
    bucket_seconds: int = 3600,
) -> DataFrame:
    """For every event the earliest candidate of the same key strictly after it (forward as-of).

    Time is cut into buckets.  Inside one (key, bucket) a window finds the answer; for
    events with none there, the first candidate of the next non-empty bucket is the
    answer, taken from a frame with one row per (key, bucket).  No inequality join is
    built, and a hot key is spread over its buckets.
    """

    def bucket_of(c: Column) -> Column:
        return F.floor(F.unix_seconds(c.cast("timestamp")) / bucket_seconds).cast("long")

    cand = candidates.select(F.col(key), F.col(candidate_time).alias("__ct")).filter(
        F.col("__ct").isNotNull()
    )
    timeline = (
        events.withColumn("__t", F.col(event_time))
        .withColumn("__ct", F.lit(None).cast("timestamp"))
        .unionByName(cand.withColumn("__t", F.col("__ct")), allowMissingColumns=True)
        .withColumn("__b", bucket_of(F.col("__t")))
    )
    # At equal instants candidates sort first, which keeps "strictly after".
    later = (
        Window.partitionBy(key, "__b")
        .orderBy(F.col("__t").asc(), F.col("__ct").asc_nulls_last())
        .rowsBetween(1, Window.unboundedFollowing)
    )
    near = timeline.withColumn("__near", F.min("__ct").over(later)).filter(F.col("__ct").isNull())
    per_bucket = (
        timeline.groupBy(key, "__b")
        .agg(F.min("__ct").alias("__first"))
        .withColumn(
            "__far",
            F.first("__first", ignorenulls=True).over(
                Window.partitionBy(key)
                .orderBy("__b")
                .rowsBetween(1, Window.unboundedFollowing)
            ),
        )
        .select(key, "__b", "__far")
    )
    return (
        near.join(per_bucket, [key, "__b"], "left")
        .withColumn(name, F.coalesce("__near", "__far"))
        .drop("__t", "__ct", "__b", "__near", "__far")
    )


def split_valid(
    df: DataFrame, checks: Sequence[tuple[str, Column]], valid: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with the first failing check as ``invalid_reason``.

    A check is (reason, condition that makes the row invalid).  ``valid`` overrides the
    plain negation where the two sides are deliberately not complementary.
    """
    bad = any_of([F.coalesce(cond, F.lit(False)) for _, cond in checks])
    reason = F.lit("unknown")
    for code, cond in reversed(checks):
        reason = F.when(cond, F.lit(code)).otherwise(reason)
    good = ~bad if valid is None else F.coalesce(valid, F.lit(False))
    return df.filter(good), df.filter(bad).withColumn("invalid_reason", reason)


def not_null_checks(*cols: str, rename: dict[str, str] | None = None) -> list[tuple[str, Column]]:
    names = rename or {}
    return [(names.get(c, f"{c}_null"), F.col(c).isNull()) for c in cols]


def align_to_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of ``target`` in its order: permissive cast, typed null if absent, extras dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (
                _soft_cast(df, f.name, f.dataType)
                if f.name in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target.fields
        ]
    )


def _soft_cast(df: DataFrame, name: str, to) -> Column:
    if df.schema[name].dataType == to:
        return F.col(f"`{name}`")
    return F.col(f"`{name}`").try_cast(to)


def union_all(frames: Sequence[DataFrame], empty: DataFrame | None = None) -> DataFrame | None:
    """Union by name with null padding; ``empty`` stands in when there is no frame."""
    if not frames:
        return empty
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
