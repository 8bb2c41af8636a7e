"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang neighbours on the smallest node known to a node.

    Minima are aggregated in each task first, so a node with very many neighbours costs one row
    a task; the join back on it is one that Spark splits.
    """
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
    if not large:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = both.filter("v > u") if large else both
    out = hung.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of the edges ``a, b``.

    Nulls and loops are left out.  Every round is stored in the shared folder; the number of
    rounds grows with the logarithm of the largest component.
    """
    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.min("a")).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        now = stored(_star(_star(now, True), False), "links")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.unionByName(roots)
