"""Incremental marts: lookback bound, merge on unique key, materialisation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import int_key, key_to_date, shift_months, year_month
from tidemark.operators.keyed import KeyedTable
from tidemark.operators.layout import z_ordered
from tidemark.operators.merge import _fail_on_duplicate_keys
from tidemark.operators.rows import align_to_schema, all_of
from tidemark.session import reliable_checkpoint

FLOOR_KEY = 20000101
_NO_MONTH = -1


def high_key(target: DataFrame, key: str) -> int | None:
    """Highest key of a target: one row to the driver, read once per run."""
    return target.agg(F.max(key)).first()[0]


def _as_date(key: int) -> dt.date:
    return dt.date(key // 10000, key // 100 % 100, key % 100)


def lower_bound(
    high: int | None, days: int = 0, months: int = 0, legacy_key_math: bool = False
) -> int:
    """Lowest date key an incremental run has to read again.

    By default the lookback is a calendar distance.  ``legacy_key_math`` subtracts from
    the ``YYYYMMDD`` number instead (31 for days, 100 per month), which near a month or
    year start reaches less far back than it says.
    """
    if high is None:
        return FLOOR_KEY
    if legacy_key_math:
        return high - days - 100 * months
    day = _as_date(high)
    if months:
        day = shift_months(day, -months)
    return int_key(day - dt.timedelta(days=days))


def month_lower_bound(high: int | None, months: int = 1, legacy_key_math: bool = False) -> int:
    """Same for ``YYYYMM`` keys."""
    if high is None:
        return FLOOR_KEY // 100
    if legacy_key_math:
        return high - months
    return int_key(shift_months(dt.date(high // 100, high % 100, 1), -months)) // 100


def since_timestamp(source_ts: Column, high: int | None, days: int = 31) -> Column:
    """Fact filter: source time on or after the target's newest day minus ``days``.

    The bound is a literal; it reaches the file scan if the time is a stored timestamp.  Where it
    is made of text, put ``since_text`` on the text beside it.
    """
    day = _as_date(high if high is not None else FLOOR_KEY) - dt.timedelta(days=days)
    return source_ts >= F.lit(day.isoformat()).cast("timestamp")


def since_text(text: Column, high: int | None, days: int = 31) -> Column:
    """What ``since_timestamp`` may keep, told from the text of the time, which a scan can prune by.

    ISO texts order like their times; one more day covers zone offsets.  Texts that begin with no
    digit are kept for the exact filter to judge, and years are taken to have four digits.
    """
    day = _as_date(high if high is not None else FLOOR_KEY) - dt.timedelta(days=days + 1)
    return (text >= day.isoformat()) | (text < "0")


def lookback_days(
    rows: DataFrame, key: str, target: DataFrame, target_key: str, days: int = 31,
    legacy_key_math: bool = False,
) -> DataFrame:
    """Rows inside the lookback, with the bound computed inside the plan from ``target``."""
    high = F.max(target_key)
    if legacy_key_math:
        bound = F.coalesce(high - days, F.lit(FLOOR_KEY))
    else:
        day = F.date_sub(key_to_date(F.coalesce(high, F.lit(FLOOR_KEY))), days)
        bound = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return rows.filter(F.col(key) >= target.agg(bound.cast("long")).scalar())


def incremental_merge(
    target: DataFrame, new: DataFrame, unique_key: Sequence[str], full_refresh: bool = False
) -> DataFrame:
    """Target with the rows of ``new`` replaced or inserted by unique key.

    Key parts compare null-safe, so a rerun is idempotent even where a key part (such as
    a room) is null.  A key that occurs twice in ``new`` fails the job.
    """
    if full_refresh:
        return align_to_schema(new, target.schema)
    new = _fail_on_duplicate_keys(new, list(unique_key)).select(*new.columns)
    kept = target.join(*_replaced_by(target, new, unique_key), "left_anti")
    return kept.unionByName(align_to_schema(new, target.schema))


def _replaced_by(target: DataFrame, new: DataFrame, unique_key: Sequence[str]):
    """Key frame of ``new`` and the null-safe condition that matches it to ``target``."""
    keys = new.select(*[F.col(k).alias(f"__{k}") for k in unique_key])
    return keys, all_of([target[k].eqNullSafe(keys[f"__{k}"]) for k in unique_key])


def key_months(df: DataFrame, unique_key: Sequence[str]) -> DataFrame:
    """``key, months``: a digest of each unique key, nulls included, and the months it is stored in
    (one, unless the stored mart repeats a key)."""
    key = F.md5(F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in unique_key]), {"ignoreNullFields": "false"}))
    rows = df.select(key.alias("key"), F.coalesce(F.col("yyyymm").cast("int"), F.lit(_NO_MONTH)).alias("yyyymm"))
    return rows.groupBy("key").agg(F.collect_set("yyyymm").alias("months"))


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    unique_key: Sequence[str],
    date_col: str,
    index: KeyedTable | None = None,
) -> None:
    """Merge into a parquet mart laid out by month of ``date_col``; untouched months stay.

    Months to rewrite are those of the new rows and those where a replaced row sits now.  With
    ``index``, a keyed table of ``key_months``, the latter are looked up there and no other month
    of the mart is read; without, the whole mart is searched.
    The new rows are built once, into a reliable checkpoint, as they are read for the months,
    the rows they replace and the result.  The merged months go through another one, because
    files being read cannot be overwritten; the write is a dynamic partition overwrite.
    """
    target = spark.read.parquet(path)
    new = reliable_checkpoint(new.withColumn("yyyymm", year_month(date_col)))
    if index is None:
        held = target.join(*_replaced_by(target, new, unique_key), "left_semi").select("yyyymm")
    else:
        asked = key_months(new, unique_key).select("key")
        held = index.find(asked).select(F.explode("months").alias("m")).select(F.nullif("m", F.lit(_NO_MONTH)).alias("yyyymm"))
    months = new.select("yyyymm").union(held).distinct()
    # One small integer per month of history.
    touched = [r.yyyymm for r in months.collect()]
    if not touched:
        return
    part = F.col("yyyymm").isin([m for m in touched if m is not None])
    if None in touched:
        part = part | F.col("yyyymm").isNull()
    merged = incremental_merge(target.filter(part), new, unique_key)
    write_by_month(reliable_checkpoint(merged), path, dynamic=True)
    if index is not None:
        index.merge(key_months(new, unique_key), source_is_unique=True)


def write_by_month(
    df: DataFrame, path: str, cluster: Sequence[str] = (), dynamic: bool = False,
    date_col: str | None = None, interleave: bool = False,
) -> None:
    """Parquet partitioned by ``YYYYMM`` and sorted by the cluster columns inside each file.

    ``rebalance`` lets adaptive execution size the files, splitting a month that holds
    far more rows than the others.  With ``interleave`` the files follow a curve through all
    cluster columns, for marts that are filtered by any of them; that reads ``df`` twice.
    """
    if date_col is not None:
        df = df.withColumn("yyyymm", year_month(date_col))
    if interleave and len(cluster) > 1:
        out = z_ordered(df, cluster, within=["yyyymm"])
    else:
        out = df.hint("rebalance", "yyyymm")
    if cluster and not (interleave and len(cluster) > 1):
        out = out.sortWithinPartitions("yyyymm", *cluster)
    writer = out.write.mode("overwrite").partitionBy("yyyymm")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def materialize(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    mode: str = "table",
    unique_key: Sequence[str] = (),
    full_refresh: bool = False,
    path: str | None = None,
    date_col: str | None = None,
) -> DataFrame:
    """Publish a model as ``view``, ``table`` (full rewrite) or ``incremental`` (keyed merge)."""
    if mode == "view":
        build().createOrReplaceTempView(name)
        return spark.table(name)
    if mode == "table":
        writer = build().write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return spark.table(name)
    if mode != "incremental" or path is None or date_col is None:
        raise ValueError("incremental models need a path and a date column")
    from tidemark.sources.files import exists

    if full_refresh or not exists(spark, path):
        write_by_month(build(), path, date_col=date_col)
    else:
        merge_into_partitions(spark, path, build(), unique_key, date_col)
    return spark.read.parquet(path).drop("yyyymm")
