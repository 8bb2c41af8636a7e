"""Change-event normalisation: envelope to flat rows with ordering columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tidemark.functions.keys import SEQUENCE, lsn_to_num, regex_or_null

_OPS = {"INSERT": "c", "UPDATE": "u", "DELETE": "d"}


def _type_at(schema: StructType, path: str) -> DataType | None:
    current: DataType | None = schema
    for part in path.split("."):
        if not isinstance(current, StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def _field(df: DataFrame, path: str, default: Column) -> Column:
    return F.col(path) if _type_at(df.schema, path) is not None else default


def commit_ts(df: DataFrame) -> tuple[Column, bool]:
    """Commit instant and whether it had to be inferred, chosen from what the schema offers."""
    for path, inferred, from_number in (
        ("source_metadata.source_timestamp", False, F.timestamp_micros),
        ("source_timestamp", False, F.timestamp_micros),
        ("read_timestamp", True, F.timestamp_millis),
    ):
        kind = _type_at(df.schema, path)
        if kind is None:
            continue
        if kind.typeName() in ("timestamp", "timestamp_ntz"):
            return F.col(path).cast("timestamp"), inferred
        if kind.typeName() in ("long", "integer"):
            return from_number(F.col(path).cast("long")), inferred
    return F.current_timestamp(), True


def op_code(change_type: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for word, code in _OPS.items():
        out = out.when(change_type == word, F.lit(code))
    return out


def flatten_envelope(
    df: DataFrame, run_id: str, source_date: str | Column, raw_path: Column | None = None
) -> DataFrame:
    """Payload columns plus the fifteen ``__`` metadata columns; absent ones become null."""
    null = F.lit(None).cast("string")
    stamp, inferred = commit_ts(df)
    source_date = F.lit(source_date) if isinstance(source_date, str) else source_date
    deleted = _field(df, "source_metadata.is_deleted", F.lit(False)).cast("boolean")
    return df.select(
        "payload.*",
        op_code(F.col("source_metadata.change_type")).alias("__op"),
        _field(df, "source_metadata.lsn", null).alias("__lsn"),
        _field(df, "source_metadata.tx_id", null).alias("__tx_id"),
        _field(df, "source_metadata.schema", null).alias("__schema"),
        _field(df, "source_metadata.table", null).alias("__table"),
        F.coalesce(deleted, F.lit(False)).alias("__is_deleted"),
        stamp.alias("__commit_ts"),
        F.lit(inferred).alias("__commit_ts_inferred"),
        _field(df, "read_timestamp", null).alias("__read_ts"),
        _field(df, "stream_name", null).alias("__stream"),
        _field(df, "uuid", null).alias("__uuid"),
        F.current_timestamp().alias("__ingest_ts"),
        F.lit(run_id).alias("__run_id"),
        source_date.alias("__source_date_local"),
        (F.input_file_name() if raw_path is None else raw_path).alias("__raw_path"),
    )


def commit_digits(ts: Column) -> Column:
    """Twenty digits, fixed width, so numeric order equals time order."""
    return F.date_format(ts, "yyyyMMddHHmmssSSSSSS").cast(SEQUENCE)


def sequence_columns(df: DataFrame) -> DataFrame:
    """``__lsn_num`` from the log position, or inferred from file number or commit time.

    Inferred = base * 10^6 + a stable tie-break in 0..999999.  The base can have twenty
    digits, so the sequence is ``decimal(38,0)``; 64 bits would wrap.
    """
    lsn = F.when(F.trim("__lsn") != "", F.col("__lsn"))
    real = lsn_to_num(lsn)
    tie = F.crc32(F.coalesce(F.col("__uuid").cast("string"), F.col("__raw_path"))) % 1_000_000
    file_base = regex_or_null("__raw_path", r"(?:backfill_|snapshot_|initial_)(\d+)")
    base = F.coalesce(file_base.try_cast(SEQUENCE), commit_digits(F.col("__commit_ts")))
    million = F.lit(1_000_000).cast("decimal(7,0)")
    inferred = (base * million + F.coalesce(tie, F.lit(0)).cast("decimal(7,0)")).cast(SEQUENCE)
    number = F.coalesce(real, inferred)
    return df.withColumns(
        {
            "__lsn": lsn,
            "__lsn_num_inferred": real.isNull(),
            "__lsn_num": number,
            "__event_seq": number,
        }
    )


def mark_deleted(df: DataFrame) -> DataFrame:
    """Deleted by metadata, by ``deleted_at``, or by a delete operation."""
    flag = F.col("__is_deleted") | F.coalesce(F.col("__op") == "d", F.lit(False))
    if "deleted_at" in df.columns:
        flag = flag | F.col("deleted_at").isNotNull()
    return df.withColumn("__is_deleted", flag)


def normalize_changes(
    df: DataFrame,
    run_id: str,
    source_date: str | Column,
    infer_seq: bool = True,
    raw_path: Column | None = None,
) -> DataFrame:
    """Nested change events -> flat rows ready for the keyed merge."""
    flat = flatten_envelope(df, run_id, source_date, raw_path)
    return mark_deleted(sequence_columns(flat) if infer_seq else flat)
