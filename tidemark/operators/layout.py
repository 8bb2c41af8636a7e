"""Interleaved layout: files whose row groups are narrow in several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranks of a column, two to this power.
RANK_BITS = 6


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list]:
    """Values that cut each column into ``2**bits`` parts of about equal rows, in one pass.

    A column with few values has fewer parts.  At most ``2**bits`` values a column come to the
    driver, whatever the rows.
    """
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(c, cuts, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def rank_of(column: Column, bounds: Sequence) -> Column:
    """How many bounds a value has reached, by halving; nulls come first, with 0."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(bounds[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return F.when(column.isNull(), 0).otherwise(between(0, len(bounds)))


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """One number whose bits are those of the ranks in turn, highest first (a Z-order curve)."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - place))
    return out


def z_ordered(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS, within: Sequence[str] = ()) -> DataFrame:
    """``df`` dealt and sorted along the curve through ``columns``, inside each ``within``.

    A filter on any of the columns then leaves out most row groups by their statistics; a plain
    sort helps its first column only.  Ranks, not values, are interleaved, so skewed columns are
    cut evenly; many equal rows may fill several tasks, as range partitions of one key are cut by
    the remaining columns.
    """
    bounds = rank_bounds(df, columns, bits)
    curve = interleaved([rank_of(F.col(c), bounds[c]) for c in columns], bits)
    keyed = df.withColumn("__curve", curve)
    order = [*within, "__curve", *columns]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__curve")
