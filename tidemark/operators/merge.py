"""Watermarked keyed merges on plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import tuple_text_to_utc
from tidemark.functions.keys import SEQUENCE, extract_numeric
from tidemark.operators.contract import Contract
from tidemark.operators.rows import keep_first
from tidemark.session import reliable_checkpoint

_SYSTEM = ("is_deleted", "__lsn_num", "__commit_ts")
_ROW_TIES = ("__uuid", "__raw_path")


def run_scoped_source(
    stage: DataFrame, source_date: str, run_id: str, last_lsn=0, last_inferred=0
) -> DataFrame:
    """Rows of one (date, run) above the watermark of their class.

    The watermark is two scalars, so both bounds are literals that reach the scan
    beside the partition filter.  A null class flag counts for both classes.
    """
    seq = F.col("__lsn_num").try_cast(SEQUENCE)
    flag = F.col("__lsn_num_inferred").cast("boolean")
    real = ~F.coalesce(flag, F.lit(False)) & (seq > F.lit(last_lsn).cast(SEQUENCE))
    inferred = F.coalesce(flag, F.lit(True)) & (seq > F.lit(last_inferred).cast(SEQUENCE))
    return stage.filter(
        (F.col("__source_date_local").cast("string") == source_date)
        & (F.col("__run_id").cast("string") == run_id)
        & (real | inferred)
    )


def above_watermark(stage: DataFrame, watermark: DataFrame) -> DataFrame:
    """As ``run_scoped_source`` but against a watermark frame, read by scalar subqueries."""

    def bound(name: str) -> Column:
        return watermark.agg(F.coalesce(F.max(name), F.lit(0)).cast(SEQUENCE)).scalar()

    flag = F.col("__lsn_num_inferred").cast("boolean")
    seq = F.col("__lsn_num").try_cast(SEQUENCE)
    real = ~F.coalesce(flag, F.lit(False)) & (seq > bound("last_lsn_num"))
    inferred = F.coalesce(flag, F.lit(True)) & (seq > bound("last_inferred_seq"))
    return stage.filter(real | inferred)


def business_columns(contract: Contract, zone: str = "UTC") -> list[Column]:
    """Contract columns with decimal tokens extracted and timestamp texts normalised."""
    decimals, stamps = set(contract.decimal_fields), set(contract.timestamp_fields)
    out = []
    for name in contract.columns:
        if name in decimals:
            out.append(extract_numeric(name).alias(name))
        elif name in stamps:
            out.append(tuple_text_to_utc(name, zone).alias(name))
        else:
            out.append(F.col(name))
    return out


def latest_per_key(
    source: DataFrame, contract: Contract, zone: str = "UTC", commit_first: bool = False
) -> DataFrame:
    """Newest event per key: sequence, then commit time, then run id, all descending.

    Real and inferred sequences share one scale, on which inferred ones always win;
    ``commit_first`` puts the commit time before the sequence.
    """
    by = [F.col("__lsn_num").try_cast(SEQUENCE), F.col("__commit_ts")]
    order = [
        *[c.desc_nulls_last() for c in (reversed(by) if commit_first else by)],
        F.col("__run_id").desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in _ROW_TIES if c in source.columns],
    ]
    newest = keep_first(source, contract.primary_key, order)
    return newest.select(
        *business_columns(contract, zone),
        F.col("__is_deleted").cast("boolean").alias("is_deleted"),
        F.col("__lsn_num").try_cast(SEQUENCE).alias("__lsn_num"),
        F.col("__commit_ts").cast("timestamp").alias("__commit_ts"),
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when: str | None = "newer",
    source_is_unique: bool = False,
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """New version of ``target``: matched rows take the source's values, others are inserted.

    ``when='newer'`` updates only if the source sequence is higher (a null target
    sequence counts as -1); ``when='newer_commit'`` compares commit time, then sequence;
    ``when=None`` always updates.  Columns the source does not
    have, and those in ``insert_only`` on matched rows, keep the target's value.  Nothing
    is ever deleted; deletes are flag updates.
    A source key that occurs twice fails the job, as a merge must; ``source_is_unique``
    skips that check where the source was just reduced to one row per key.
    """
    cols = target.columns
    unique = source if source_is_unique else _fail_on_duplicate_keys(source, keys)
    t, s = target.alias("t"), unique.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    s_hit, t_hit = F.col("s.__hit").isNotNull(), F.col("t.__hit").isNotNull()
    take = s_hit & ~t_hit
    newer = F.col("s.__lsn_num") > F.coalesce(F.col("t.__lsn_num"), F.lit(-1))
    if when == "newer":
        take = take | (s_hit & t_hit & newer)
    elif when == "newer_commit":
        mine, theirs = F.col("s.__commit_ts"), F.col("t.__commit_ts")
        later = theirs.isNull() | (mine > theirs) | ((mine == theirs) & newer)
        take = take | (s_hit & t_hit & later)
    elif when is None:
        take = s_hit
    else:
        raise ValueError(f"unknown merge condition: {when!r}")
    joined = t.withColumn("__hit", F.lit(True)).alias("t").join(
        s.withColumn("__hit", F.lit(True)).alias("s"), on, "full_outer"
    )

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}")).alias(name)
        if name not in source.columns:
            return F.col(f"t.{name}").alias(name)
        use_source = take & ~t_hit if name in insert_only else take
        return F.when(use_source, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return joined.select(*[merged(c) for c in cols])


BUCKET = "__bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def create_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """Write a keyed table laid out by hash bucket of its key, for ``merge_into_buckets``."""
    laid = with_bucket(df, keys, buckets).hint("rebalance", BUCKET)
    laid.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def merge_into_buckets(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int = 256,
    when: str | None = "newer",
    source_is_unique: bool = False,
) -> list[int]:
    """``merge_upsert`` of a small run into a stored table: only buckets that hold a key of the
    source are read and written, the files of the others stay as they are.

    ``buckets`` is a property of the table and must stay the same.  The source is built once and
    the merged buckets go through a reliable checkpoint, because files being read cannot be
    overwritten.  Returns the buckets written, at most ``buckets`` small numbers.
    """
    fresh = reliable_checkpoint(with_bucket(source, keys, buckets))
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    if not touched:
        return []
    stored = spark.read.parquet(path)
    target = stored.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = merge_upsert(target, fresh.drop(BUCKET), keys, when, source_is_unique)
    out = reliable_checkpoint(with_bucket(merged, keys, buckets).select(*stored.columns))
    writer = out.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return touched


def _fail_on_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; running the plan raises if a key repeats.

    One grouped aggregate on the merge keys: partial counts before the shuffle, and the
    join that follows reuses its partitioning.  The check is a filter on the count, so it
    stays whatever columns are read later.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*(rest or keys))).alias("__row")
    )
    message = F.concat(
        F.lit("duplicate merge key: "), F.to_json(F.struct(*[F.col(k) for k in keys]))
    )
    single = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return grouped.filter(single).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def create_if_absent(
    target: DataFrame | None, stage: DataFrame, contract: Contract, zone: str = "UTC"
) -> DataFrame:
    """The target, or, on the first run, the newest row per key of the whole stage."""
    return latest_per_key(stage, contract, zone) if target is None else target


def watermark_of(source: DataFrame, table: str, run_id: str, now: Column) -> DataFrame:
    """One-row watermark of a source: class-wise maximum sequence and latest commit."""
    flag = F.col("__lsn_num_inferred").cast("boolean")
    seq = F.col("__lsn_num").try_cast(SEQUENCE)
    return source.agg(
        F.max(F.when(~F.coalesce(flag, F.lit(False)), seq)).alias("last_lsn_num"),
        F.max(F.when(F.coalesce(flag, F.lit(True)), seq)).alias("last_inferred_seq"),
        F.max(F.col("__commit_ts").cast("timestamp")).alias("last_commit_ts"),
    ).select(
        F.lit(table).alias("table_name"),
        "last_lsn_num",
        "last_inferred_seq",
        "last_commit_ts",
        F.lit(run_id).alias("last_run_id"),
        now.cast("timestamp").alias("updated_at"),
    )


def watermark_upsert(watermarks: DataFrame, new: DataFrame) -> DataFrame:
    """Monotone upsert: a watermark never moves back, whatever order runs arrive in."""
    w, x = watermarks.alias("w"), new.alias("x")
    joined = w.join(x, F.col("w.table_name") == F.col("x.table_name"), "full_outer")
    matched = F.col("w.table_name").isNotNull() & F.col("x.table_name").isNotNull()

    def highest(name: str) -> Column:
        old, cur = F.col(f"w.{name}"), F.col(f"x.{name}")
        zero = F.lit(0).cast(SEQUENCE)
        both = F.greatest(F.coalesce(old, zero), F.coalesce(cur, zero))
        return F.when(matched, both).otherwise(F.coalesce(old, cur)).alias(name)

    return joined.select(
        F.coalesce("w.table_name", "x.table_name").alias("table_name"),
        highest("last_lsn_num"),
        highest("last_inferred_seq"),
        F.greatest("w.last_commit_ts", "x.last_commit_ts").alias("last_commit_ts"),
        F.coalesce("x.last_run_id", "w.last_run_id").alias("last_run_id"),
        F.coalesce("x.updated_at", "w.updated_at").alias("updated_at"),
    )


def apply_run(
    target: DataFrame | None,
    stage: DataFrame,
    contract: Contract,
    watermark: DataFrame | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """One merge run: scope to new events, newest per key, then upsert.

    A watermark drops what it passed, also the late first event of a key.  Without one every
    event of the run is held against the stored row of its own key, and none is lost.
    """
    base = create_if_absent(target, stage, contract, zone)
    if target is None:
        return base
    new = stage if watermark is None else above_watermark(stage, watermark)
    fresh = latest_per_key(new, contract, zone)
    return merge_upsert(base, fresh, contract.primary_key, source_is_unique=True)
