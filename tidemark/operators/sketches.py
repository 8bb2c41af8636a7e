"""Quantiles over long windows from sketches kept per hour; the log is read once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a sketch's lowest level.  Up to that many values a sketch is exact; above, the rank
#: of a quantile is off by about 2.3 / k of all values, 99 times in 100.
K = 1000
RANK_ERROR = 2.3 / K


def hourly_sketches(df: DataFrame, time: str, keys: Sequence[str], value: Column, k: int = K) -> DataFrame:
    """``hour_bucket``, ``keys``, ``n`` and ``sketch`` of the non-null values of each hour.

    Sketches are partial aggregates: a task sends one for each hour and key, whatever the number
    of rows.  Write the result by day and keep it; a late hour is built anew by itself.
    """
    rows = df.select(F.date_trunc("hour", time).alias("hour_bucket"), *keys, value.cast("double").alias("__value"))
    return rows.filter("__value is not null").groupBy("hour_bucket", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__value", k).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """One sketch for each ``keys`` of the given hours; merging loses no accuracy to speak of."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantile(sketch: Column | str, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def window_quantile(
    sketches: DataFrame, keys: Sequence[str], q: float, first: Column, last: Column, name: str, k: int = K
) -> DataFrame:
    """``keys, n, name``: the quantile over the hours from ``first`` to before ``last``."""
    hours = sketches.filter((F.col("hour_bucket") >= first) & (F.col("hour_bucket") < last))
    return merged_sketches(hours, keys, k).select(*keys, "n", quantile("sketch", q).alias(name))


def rank_band(rows: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, estimate: str, q: float, error: float = RANK_ERROR) -> DataFrame:
    """``keys, n, in_band``: whether the rank of each estimate among all rows is within ``error`` of ``q``.

    One pass over the rows that are to be checked; estimates are one row per key.
    """
    at, x = F.col(estimate), F.col(value)
    ranked = rows.filter(x.isNotNull()).join(estimates.select(*keys, estimate), list(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(x < at).alias("below"), F.count_if(x <= at).alias("upto")
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    return ranked.select(*keys, "n", ((low <= q + error) & (high >= q - error)).alias("in_band"))
