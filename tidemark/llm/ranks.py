"""Exact places of rows in their groups and skew-proof lookups, both without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.scratch import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def positions(df: DataFrame, group: str, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``pos``, the rows of its ``group`` before a row, and ``of``, the rows of the group.

    With ``weight`` also ``start``, the sum of the weights before it.  Groups and rows are
    ordered ascending, nulls first; ``order`` must tell apart all rows but equal ones.

    The rows are sorted over range partitions, which cut a group of any size, and written; what
    lies before a partition comes from one row for each partition and group, so a group is never
    gathered.  ``group`` holds no nulls.
    """
    placed = stored(
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33)),
        name,
    )
    heavy = F.sum(weight) if weight else F.count(F.lit(1))
    parts = placed.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"), heavy.alias("_load")
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group,
        "_part",
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_load").over(earlier), F.lit(0)).alias("_ahead"),
        F.sum("_n").over(Window.partitionBy(group)).alias("of"),
    )
    out = placed.join(parts, [group, "_part"]).withColumn("pos", F.expr("_before + _place - _first"))
    if weight:
        inside = Window.partitionBy(group, "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("start", F.col("_ahead") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return out.select(*df.columns, "pos", "of", *(["start"] if weight else []))


def lookup(rows: DataFrame, key: str, table: DataFrame, weight: str, share: int = 1_000) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which holds each ``key`` once.

    ``weight`` is about how many rows ask for a key.  Keys that over one in ``share`` of all such
    rows ask for are fewer than ``share``: they are broadcast, so their rows stay where they are.
    The others meet in a merge join, in which no key is hot.  Both inputs are stored tables.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = table.filter(F.col(weight) * share > total)
    cold = table.filter(F.col(weight) * share <= total)
    asked = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(asked.join(cold.hint("merge"), key))
