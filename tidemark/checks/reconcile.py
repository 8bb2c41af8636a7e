"""Data tests and cross-layer reconciliation.  Every check returns the failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rows import all_of, any_of, union_all


def class_counts(
    df: DataFrame, checks: Sequence[tuple[str, Column]], valid: Column | None = None
) -> DataFrame:
    """Rows per class (valid, invalid, unclassified) in one pass over the base."""
    bad = any_of([F.coalesce(c, F.lit(False)) for _, c in checks])
    good = ~bad if valid is None else F.coalesce(valid, F.lit(False))
    part = F.when(good, "valid").when(bad, "invalid").otherwise("unclassified")
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def failing_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """One row per column: how many nulls it holds."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failing_rows")) for c in cols]
    )
    return counts.select(F.inline(pairs)).filter("failing_rows > 0")


def failing_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Non-null key values that occur more than once."""
    return (
        df.filter(all_of([F.col(c).isNotNull() for c in cols]))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .filter("dup_count > 1")
    )


def failing_accepted(df: DataFrame, col: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted set with their row counts."""
    return (
        df.filter(~F.col(col).isin(*accepted))
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def missing_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Key values of the fact without a dimension row (distinct before the join)."""
    return fact.select(key).filter(F.col(key).isNotNull()).distinct().join(
        dim.select(key), key, "left_anti"
    )


def lost_rows(base: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Base rows found in none of the parts, duplicates counted."""
    cols = base.columns
    return base.exceptAll(union_all([p.select(*cols) for p in parts]))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per layer, for comparing one table across layers."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
            for name, df in layers.items()
        ]
    )
