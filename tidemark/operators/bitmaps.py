"""Exact distinct counts that add up: bitmaps of whole-number ids per day, united to any period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, groups: Sequence[str], id_col: Column) -> DataFrame:
    """``groups, id_bucket, ids``: which ids occur in each group, 64 ids to a bitmap.

    A bitmap is one machine word, so scattered ids take no more room than their rows, however
    far the ids span; ids that lie close together share one.  Null ids count nowhere, as in
    COUNT(DISTINCT).  Bits are set in partial aggregates, so a hot group sends one bitmap per
    task and bucket.
    """
    rows = df.select(*groups, id_col.cast("long").alias("__id")).filter("__id is not null")
    bit = F.expr("shiftleft(1L, cast(__id & 63 as int))")
    return rows.groupBy(*groups, F.expr("shiftright(__id, 6)").alias("id_bucket")).agg(F.bit_or(bit).alias("ids"))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """``groups, name``: distinct ids of each group, from stored bitmaps of finer groups."""
    united = bitmaps.groupBy(*groups, "id_bucket").agg(F.bit_or("ids").alias("ids"))
    return united.groupBy(*groups).agg(F.sum(F.bit_count("ids")).alias(name))
