"""Table patterns that recur across the jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.rows import all_of, union_all


def latest_value(df: DataFrame, column: str, order: str) -> Column:
    """``column`` of the newest row as a scalar, usable in any other frame.

    One aggregate row joins nothing: Spark runs it once and uses the value as a literal.
    """
    return df.agg(F.max_by(column, F.struct(order, column))).scalar()


def not_in(df: DataFrame, key: str, listed: DataFrame, column: str) -> DataFrame:
    """Rows whose key is not in the list.  Nulls in the list are ignored.

    Plain SQL ``NOT IN`` returns nothing at all once the list holds a null.  A null key
    compares as unknown and is dropped here as there.
    """
    values = listed.select(F.col(column).alias("__v")).filter("__v is not null").distinct()
    return df.filter(F.col(key).isNotNull()).join(values, df[key] == values["__v"], "left_anti")


def flag_first(df: DataFrame, key: str, time: str, name: str) -> DataFrame:
    """Mark the rows at each key's earliest time.

    The minimum is a partial aggregate joined back, so a key with a third of all rows is
    not sorted in one window task.
    """
    first = df.groupBy(key).agg(F.min(time).alias("__first"))
    return df.join(first, key).withColumn(name, F.col(time) == F.col("__first")).drop("__first")


def first_distinct(
    df: DataFrame, keys: Sequence[str], column: str, n: int, name: str
) -> DataFrame:
    """The first ``n`` distinct non-null values per key as a sorted array.

    Values are made distinct before they are ranked and only ``n`` per key are collected,
    so no list grows with the data.
    """
    distinct = df.filter(F.col(column).isNotNull()).select(*keys, column).distinct()
    window = Window.partitionBy(*keys).orderBy(column)
    top = distinct.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= n)
    listed = top.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias(name))
    groups = df.select(*keys).distinct()
    left = groups.select(*[F.col(k).alias(f"__{k}") for k in keys])
    on = all_of([left[f"__{k}"].eqNullSafe(listed[k]) for k in keys])
    joined = left.join(listed, on, "left")
    empty = F.array().cast(listed.schema[name].dataType)
    return joined.select(
        *[F.col(f"__{k}").alias(k) for k in keys], F.coalesce(F.col(name), empty).alias(name)
    )


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float, name: str,
    margin: float = 0.001, accuracy: int = 10_000,
) -> DataFrame:
    """Discrete percentile: the smallest value whose cumulative share reaches ``fraction``.

    A sketch first brackets the answer (its rank error is far inside the bracket).  Values
    below the bracket are only counted and those above dropped, so the cumulative window
    sees the few distinct values inside it, however many rows a group has.  The counts also
    tell whether the bracket holds the rank; a group where it does not is done again over all
    its distinct values.
    """
    points = F.array(F.lit(max(0.0, fraction - margin)), F.lit(min(1.0, fraction + margin)))
    known = df.select(*keys, value).filter(F.col(value).isNotNull())
    bounds = known.groupBy(*keys).agg(
        F.percentile_approx(value, points, accuracy).alias("__b"), F.count(F.lit(1)).alias("__total")
    )
    low, high = F.col("__b")[0], F.col("__b")[1]
    bounds = bounds.select(*[F.col(k).alias(f"__{k}") for k in keys], "__b", "__total")
    same_key = all_of([known[k].eqNullSafe(bounds[f"__{k}"]) for k in keys])
    hist = (
        known.join(bounds, same_key)
        .filter(F.col(value) <= high)
        .groupBy(*keys, "__total", F.when(F.col(value) >= low, F.col(value)).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    upto = (
        Window.partitionBy(*keys)
        .orderBy(F.col("__v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        hist.withColumn("__cum", F.sum("__n").over(upto))
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("__v").isNotNull() & (F.col("__cum") >= F.col("__total") * fraction), F.col("__v"))).alias(name),
            # The rank lies below the bracket if the values below it reach it already.
            F.coalesce(
                F.max(F.col("__v").isNull() & (F.col("__cum") >= F.col("__total") * fraction)), F.lit(False)
            ).alias("__below"),
        )
    )
    missed = F.col("__below") | F.col(name).isNull()
    again = found.filter(missed).select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = all_of([known[k].eqNullSafe(again[f"__{k}"]) for k in keys])
    counted = known.join(again, same, "left_semi").groupBy(*keys, F.col(value).alias("__v")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    whole = Window.partitionBy(*keys)
    exact = (
        counted.select("*", F.sum("__n").over(upto).alias("__cum"), F.sum("__n").over(whole).alias("__total"))
        .filter(F.col("__cum") >= F.col("__total") * fraction)
        .groupBy(*keys)
        .agg(F.min("__v").alias(name))
    )
    return found.filter(~missed).drop("__below").unionByName(exact)


def tables_like(spark: SparkSession, pattern: str, required: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Tables and views of the catalog whose name matches and that have all required columns."""
    found = {t.name: spark.table(t.name) for t in spark.catalog.listTables(pattern=pattern)}
    return {name: df for name, df in sorted(found.items()) if {*required} <= {*df.columns}}


def per_table(
    tables: Mapping[str, DataFrame], summarise: Callable[[DataFrame], DataFrame]
) -> DataFrame | None:
    """One summary per table, united; None if there is no table."""
    parts = [
        summarise(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()
    ]
    return union_all(parts)


def latest_partition(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Rows at the highest value of the first candidate column that exists."""
    for name in candidates:
        if name in df.columns:
            return df.filter(F.col(name) == df.agg(F.max(name)).scalar())
    return df
