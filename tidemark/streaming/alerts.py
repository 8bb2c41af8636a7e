"""Windowed alerts on change messages; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCE_TABLE = "public.clinic_bookings"
SPIKE_THRESHOLD = 120
VALID_OPS = ("c", "u", "d", "r")
_MESSAGE = (
    "op string, ts_ms long, source struct<schema:string,`table`:string>, before string, after string"
)


def _has_fields(c: Column) -> Column:
    """The text is a JSON object with at least one member."""
    return F.coalesce(c.rlike(r"^\s*\{\s*[^}\s]"), F.lit(False))


def parse_messages(
    messages: DataFrame, source_table: str = SOURCE_TABLE, now: Column | None = None
) -> DataFrame:
    """JSON messages -> created rows of the watched table with their event time.

    The payload wrapper is optional.  Broken JSON, other operations, other tables and
    messages without row content drop out; a missing time becomes ``now``.
    """
    body = F.coalesce(F.get_json_object("value", "$.payload"), F.col("value"))
    m = F.from_json(body, _MESSAGE, {"mode": "PERMISSIVE"})
    op = F.lower(m["op"])
    schema, table = F.trim(m["source"]["schema"]), F.trim(m["source"]["table"])
    named = F.when((schema != "") & (table != ""), F.concat_ws(".", schema, table))
    at = F.coalesce(
        F.timestamp_millis(F.nullif(m["ts_ms"], F.lit(0))),
        F.current_timestamp() if now is None else now.cast("timestamp"),
    )
    extra = [c for c in messages.columns if c != "value"]
    return (
        messages.select(
            *extra,
            op.alias("op"),
            F.coalesce(named, F.lit(source_table)).alias("source_table"),
            at.alias("event_time"),
            (_has_fields(m["before"]) | _has_fields(m["after"])).alias("__row"),
        )
        .filter((F.col("op") == "c") & F.col("__row"))
        .filter(F.lower("source_table") == source_table.lower())
        .drop("__row")
    )


def count_windows(
    events: DataFrame,
    length: str = "1 minute",
    time: str = "event_time",
    lateness: str = "0 seconds",
) -> DataFrame:
    """Events per tumbling window.  Counts combine inside each task before the shuffle, so
    one global count needs no hot task."""
    if events.isStreaming:
        events = events.withWatermark(time, lateness)
    counted = events.groupBy(F.window(time, length)).agg(F.count(F.lit(1)).alias("total_events"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_events",
    )


def spike_alerts(
    counts: DataFrame, threshold: int = SPIKE_THRESHOLD, source_table: str = SOURCE_TABLE
) -> DataFrame:
    """Windows at or over the threshold; critical from twice the threshold on."""
    severity = F.when(F.col("total_events") >= 2 * threshold, "critical").otherwise("warning")
    return counts.filter(F.col("total_events") >= threshold).select(
        F.lit(source_table).alias("source_table"),
        "window_start",
        "window_end",
        F.col("window_end").alias("event_time"),
        "total_events",
        F.lit("booking_spike").alias("alert_type"),
        severity.alias("severity"),
        F.lit(f"booking_spike|{source_table}").alias("alert_key"),
    )


def cancel_ratio_alerts(
    events: DataFrame,
    cancelled: Column,
    max_ratio: float,
    length: str = "1 minute",
    time: str = "event_time",
    source_table: str = SOURCE_TABLE,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Optional rule: share of cancelled events per window over a limit."""
    if events.isStreaming:
        events = events.withWatermark(time, lateness)
    ratio = F.try_divide(F.count_if(cancelled), F.count(F.lit(1)))
    counted = events.groupBy(F.window(time, length)).agg(
        F.count(F.lit(1)).alias("total_events"), ratio.alias("cancel_ratio")
    )
    return counted.filter(F.col("cancel_ratio") > max_ratio).select(
        F.lit(source_table).alias("source_table"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("window.end").alias("event_time"),
        "total_events",
        "cancel_ratio",
        F.lit("cancel_ratio").alias("alert_type"),
        F.lit("warning").alias("severity"),
        F.lit(f"cancel_ratio|{source_table}").alias("alert_key"),
    )


def with_alert_key(alerts: DataFrame) -> DataFrame:
    """Missing keys become ``type|table``; the alert id is the SHA-1 of the key."""

    def named(name: str) -> Column:
        if name not in alerts.columns:
            return F.lit("unknown")
        return F.coalesce(F.col(name).cast("string"), F.lit("unknown"))

    fallback = F.concat_ws("|", named("alert_type"), named("source_table"))
    own = F.nullif(F.col("alert_key"), F.lit("")) if "alert_key" in alerts.columns else F.lit(None)
    key = F.coalesce(own.cast("string"), fallback)
    return alerts.withColumn("alert_key", key).withColumn("alert_id", F.sha1("alert_key"))


def history_rows(alerts: DataFrame, created_at: Column) -> DataFrame:
    """Immutable history: one row per alert seen, with its payload and whether it was sent."""
    payload = [c for c in alerts.columns if c not in ("emitted", "alert_id")]

    def named(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("unknown")).alias(name)

    return alerts.select(
        "alert_id",
        "alert_key",
        named("alert_type"),
        named("severity"),
        named("source_table"),
        "event_time",
        F.to_json(F.struct(*payload)).alias("payload_json"),
        created_at.cast("timestamp").alias("created_at"),
        "emitted",
    )
