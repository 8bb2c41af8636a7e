"""Operations monitors: health of tables, runs, jobs and logs.

Every function takes tables and ``now`` and reduces before anything is ranked: log tables
are aggregated with map-side partials, so a component that writes a third of all lines
stays one partial row per task and hour.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.dates import minutes_between, seconds_between
from tidemark.functions.keys import SEQUENCE, regex_or_null
from tidemark.operators.relational import latest_partition, per_table
from tidemark.operators.rows import keep_first, next_time_after, union_all

LOCAL_ZONE = "Asia/Ho_Chi_Minh"
ERROR_LEVELS = ("ERROR", "CRITICAL", "ALERT", "EMERGENCY")


def local_date(now: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(now.cast("timestamp"), zone))


def _hour(c: str = "ts") -> Column:
    return F.date_trunc("hour", c)


def _within(c: str, now: Column, hours: int | None) -> Column:
    """Whether a time lies in the last ``hours``; None takes the whole table."""
    if hours is None:
        return F.lit(True)
    return F.col(c) >= now.cast("timestamp") - F.make_interval(hours=F.lit(hours))


def _errors() -> Column:
    return F.count_if(F.col("severity").isin(*ERROR_LEVELS)).alias("error_events")


def _total(name: str = "total_events") -> Column:
    return F.count(F.lit(1)).alias(name)


def _lower_text(c: str = "text_payload") -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def _p95(name: str) -> Column:
    """Exact p95 of a column of whole units: what is merged are counts of its different values.

    For finer values over long windows see ``operators.sketches``.
    """
    return F.expr(f"cast(percentile_disc(0.95) within group (order by {name}) as long)")


def watermark_health(watermarks: DataFrame, now: Column) -> DataFrame:
    now_ts = now.cast("timestamp")
    return watermarks.select(
        local_date(now).alias("monitor_date_local"),
        "table_name",
        "last_lsn_num",
        "last_inferred_seq",
        "last_commit_ts",
        "last_run_id",
        "updated_at",
        minutes_between(F.col("updated_at"), now_ts).alias("mins_since_watermark_update"),
        minutes_between(F.col("last_commit_ts"), now_ts).alias("mins_since_last_commit"),
    )


def stage_run_quality(
    stages: Mapping[str, DataFrame], run_date: str, suffix: str = "_cdc", spark=None
) -> DataFrame:
    """Sequence and commit-time quality of one run date over all stage tables.

    Without any stage table one placeholder row says so.
    """
    null_seq = F.col("__lsn_num").try_cast(SEQUENCE).isNull()
    inferred = F.coalesce(F.col("__lsn_num_inferred").cast("boolean"), F.lit(False))
    total = F.count(F.lit(1))

    def summary(df: DataFrame) -> DataFrame:
        return df.filter(F.col("__source_date_local").cast("string") == run_date).agg(
            F.lit(run_date).alias("source_date_local"),
            total.alias("rows_total"),
            F.count_if(null_seq).alias("rows_lsn_num_null"),
            F.try_divide(F.count_if(null_seq), total).alias("lsn_num_null_ratio"),
            F.count_if(inferred).alias("rows_lsn_inferred"),
            F.try_divide(F.count_if(inferred), total).alias("lsn_inferred_ratio"),
            F.count_if(F.col("__commit_ts").isNull()).alias("rows_commit_ts_null"),
            F.max(F.col("__commit_ts").cast("timestamp")).alias("max_commit_ts"),
            F.max(F.col("__ingest_ts").cast("timestamp")).alias("max_ingest_ts"),
        )

    found = per_table({n: df for n, df in stages.items() if n.endswith(suffix)}, summary)
    if found is not None:
        return found.withColumnRenamed("table_name", "stage_table")
    nothing = F.lit(None).cast("timestamp")
    return spark.range(1).select(
        F.lit("NO_STAGE_TABLES_FOUND").alias("stage_table"),
        F.lit(run_date).alias("source_date_local"),
        *[F.lit(0).cast("long").alias(c) for c in ("rows_total", "rows_lsn_num_null")],
        F.lit(0.0).alias("lsn_num_null_ratio"),
        F.lit(0).cast("long").alias("rows_lsn_inferred"),
        F.lit(0.0).alias("lsn_inferred_ratio"),
        F.lit(0).cast("long").alias("rows_commit_ts_null"),
        nothing.alias("max_commit_ts"),
        nothing.alias("max_ingest_ts"),
    )


def silver_freshness(tables: Mapping[str, DataFrame], now: Column) -> DataFrame | None:
    """Row count, newest commit and soft-delete share of every table that has a commit time."""

    def summary(df: DataFrame) -> DataFrame:
        newest = F.max(F.col("__commit_ts").cast("timestamp"))
        total = F.count(F.lit(1))
        deleted = (
            F.count_if(F.col("is_deleted").cast("boolean"))
            if "is_deleted" in df.columns
            else F.lit(0).cast("long")
        )
        return df.agg(
            total.alias("row_count"),
            newest.alias("max_commit_ts"),
            F.max(F.col("__lsn_num").cast(SEQUENCE)).alias("max_lsn_num"),
            deleted.alias("soft_deleted_rows"),
            (
                F.try_divide(deleted, total) if "is_deleted" in df.columns else F.lit(0.0)
            ).alias("soft_deleted_ratio"),
            minutes_between(newest, now.cast("timestamp")).alias("freshness_lag_minutes"),
        )

    with_commit = {n: df for n, df in tables.items() if "__commit_ts" in df.columns}
    found = per_table(with_commit, summary)
    return None if found is None else found.withColumnRenamed("table_name", "silver_table")


def duplicate_keys(df: DataFrame, pk: str, now: Column) -> DataFrame:
    counts = df.groupBy(F.col(pk).cast("string").alias("pk_value")).agg(_total("dup_count"))
    return counts.filter("dup_count > 1").select(
        now.cast("timestamp").alias("monitor_ts_utc"),
        local_date(now).alias("monitor_date_local"),
        "pk_value",
        "dup_count",
    )


# Statements that load or change tables; fixed patterns.
JOB_PATTERNS = (r"\bmerge\b", r"\bcreate table\b", r"\binsert into\b", "dbt")


def job_health(jobs: DataFrame, now: Column, hours: int | None = 24) -> DataFrame:
    query = F.lower("query")
    relevant = F.col("job_type") == "LOAD"
    for pattern in JOB_PATTERNS:
        relevant = relevant | query.rlike(pattern)
    failed = F.col("error_result").isNotNull()
    took = seconds_between(F.col("creation_time"), F.col("end_time"))
    return (
        jobs.filter(_within("creation_time", now, hours) & relevant)
        .withColumn("__took", took)
        .groupBy(_hour("creation_time").alias("hour_bucket"))
        .agg(
            _total("jobs_total"),
            F.count_if(failed).alias("jobs_failed"),
            F.try_divide(F.count_if(failed), F.count(F.lit(1))).alias("failed_ratio"),
            F.sum("total_bytes_processed").alias("bytes_processed"),
            F.sum("total_slot_ms").alias("slot_ms"),
            _p95("__took").alias("p95_duration_sec"),
        )
    )


def object_ingest(logs: DataFrame, now: Column, hours: int | None = 24) -> DataFrame:
    """Object-store events per hour, bucket, table and method from audit lines."""
    bucket = F.coalesce(
        regex_or_null("resource_name", r"projects/_/buckets/([^/]+)/objects/"),
        regex_or_null("request_url", r"/b/([^/]+)/o/"),
    )
    path = F.coalesce(
        regex_or_null("resource_name", r"objects/(\S+)$"),
        regex_or_null("request_url", r"/o/([^?\s]+)"),
    )
    method = F.col("method_name")
    return (
        logs.filter(_within("ts", now, hours))
        .groupBy(
            _hour().alias("hour_bucket"),
            F.coalesce(bucket, F.lit("unknown")).alias("bucket_name"),
            regex_or_null(path, "^cdc/([^/]+)/").alias("table_id"),
            "method_name",
        )
        .agg(
            _total(),
            F.count_if(method.isin("storage.objects.create", "storage.objects.insert")).alias(
                "objects_created"
            ),
            F.count_if(method == "storage.objects.delete").alias("objects_deleted"),
            _errors(),
        )
    )


def _json_text(df: DataFrame, name: str) -> Column:
    """A payload as JSON text, whether it is stored as text or as a struct."""
    c = F.col(name)
    return c if isinstance(df.schema[name].dataType, StringType) else F.to_json(c)


def stream_health(logs: DataFrame, now: Column, hours: int | None = 24, methods: int = 10) -> DataFrame:
    """Stream events per hour and stream with the first distinct method names seen.

    Rows shrink to one per (hour, stream, method) first, so the list of methods is ranked
    over distinct names and never over log lines.
    """
    payload, resource = _json_text(logs, "json_payload"), _json_text(logs, "resource")
    text = F.col("text_payload")

    def first_of(*paths: str) -> Column:
        return F.coalesce(*[F.get_json_object(payload, p) for p in paths])

    status = F.coalesce(first_of("$.status.message", "$.message"), text, F.lit(""))
    stream = F.coalesce(
        regex_or_null(resource, r'"stream_id"\s*:\s*"([^"]+)"'),
        regex_or_null(payload, r'"stream_id"\s*:\s*"([^"]+)"'),
        regex_or_null(payload, r'/streams/([^"/]+)'),
        regex_or_null(text, r"/streams/([^/\s]+)"),
        F.lit("unknown"),
    )
    hint = F.lower(status).rlike("lag|backlog|failed|error")
    per_method = (
        logs.filter(_within("ts", now, hours))
        .groupBy(
            _hour().alias("hour_bucket"),
            stream.alias("stream_id"),
            first_of("$.methodName", "$.event_subtype", "$.event_type").alias("method"),
        )
        .agg(_total("n"), _errors(), F.count_if(hint).alias("hints"))
    )
    rank = F.row_number().over(
        Window.partitionBy("hour_bucket", "stream_id").orderBy(F.col("method").asc_nulls_last())
    )
    kept = F.when(F.col("rank") <= methods, F.col("method"))
    return (
        per_method.withColumn("rank", rank)
        .groupBy("hour_bucket", "stream_id")
        .agg(
            F.sum("n").alias("total_events"),
            F.sum("error_events").alias("error_events"),
            F.sum("hints").alias("lag_or_error_hints"),
            F.sort_array(F.collect_list(kept)).alias("methods_seen"),
        )
    )


def component_health(
    logs: Mapping[str, DataFrame], now: Column, hours: int | None = 24
) -> DataFrame:
    """Events and error hints per hour over the log tables of several components."""
    parts = [
        df.filter(_within("ts", now, hours)).select(
            "ts", "severity", "text_payload", F.lit(name).alias("component")
        )
        for name, df in logs.items()
    ]
    hint = _lower_text().rlike("failed|error|exception|traceback|timeout")
    return (
        union_all(parts)
        .groupBy(_hour().alias("hour_bucket"), "component")
        .agg(
            _total(),
            _errors(),
            F.count_if(hint).alias("error_hints_text"),
            F.lit(0).cast("long").alias("error_hints_json"),
        )
    )


def text_error_hints(logs: DataFrame, now: Column, hours: int | None = 24) -> DataFrame:
    hint = _lower_text().rlike("failed|error|denied|permission")
    return (
        logs.filter(_within("ts", now, hours))
        .groupBy(_hour().alias("hour_bucket"))
        .agg(
            _total(),
            _errors(),
            F.count_if(hint).alias("text_error_hints"),
            F.lit(0).cast("long").alias("json_error_hints"),
        )
    )


def scheduler_health(logs: DataFrame, now: Column, hours: int | None = 24) -> DataFrame:
    ok = F.coalesce(F.col("status"), F.lit("")) == "SUCCESS"
    return (
        logs.filter(_within("ts", now, hours))
        .groupBy(_hour().alias("hour_bucket"), F.col("location").alias("scheduler_location"), "job_id")
        .agg(
            _total(),
            _errors(),
            F.count_if(F.col("http_status") >= 400).alias("http_4xx_5xx_events"),
            F.count_if(F.col("http_status") >= 500).alias("http_5xx_events"),
            F.count_if(ok).alias("success_events"),
            F.count_if(~ok).alias("non_success_events"),
            F.try_divide(F.count_if(ok), F.count(F.lit(1))).alias("success_ratio"),
            F.max("ts").alias("latest_event_ts"),
        )
    )


def critical_slo(
    runs: DataFrame,
    windows: Mapping[str, int],
    now: Column,
    run_days: int = 30,
    slo_days: int = 14,
) -> DataFrame:
    """p95 duration, p95 recovery time and restore buffer of the critical jobs.

    Recovery = end of a failed run to the next successful start of the same job, found by a
    bucketed forward as-of, not by an inequality join.
    """
    spark = runs.sparkSession
    policy = spark.createDataFrame(
        list(windows.items()), "dag_id string, restore_window_minutes int"
    )
    recent = runs.filter(_within("start_ts", now, 24 * run_days)).select(
        "dag_id",
        F.lower(F.coalesce("status", F.lit("unknown"))).alias("status"),
        "start_ts",
        "end_ts",
        F.coalesce(
            "duration_sec", seconds_between(F.col("start_ts"), F.col("end_ts")).cast("double")
        ).alias("duration_sec"),
    )
    won = recent.filter("status = 'success'")
    p95 = (
        won.filter(_within("start_ts", now, 24 * slo_days))
        .groupBy("dag_id")
        .agg((F.expr("percentile_disc(0.95) within group (order by duration_sec)") / 60.0).alias("critical_p95_minutes"))
    )
    lost = recent.filter((F.col("status") == "failed") & _within("end_ts", now, 24 * slo_days))
    healed = next_time_after(
        lost.select("dag_id", "end_ts"), won.select("dag_id", "start_ts"),
        "dag_id", "end_ts", "start_ts", "next_success",
    ).filter("next_success is not null")
    took = minutes_between(F.col("end_ts"), F.col("next_success"))
    recovery = healed.withColumn("__took", took).groupBy("dag_id").agg(
        _p95("__took").alias("recovery_time_minutes")
    )
    return policy.join(p95, "dag_id", "left").join(recovery, "dag_id", "left").select(
        local_date(now).alias("monitor_date_local"),
        "dag_id",
        "restore_window_minutes",
        "critical_p95_minutes",
        F.coalesce("recovery_time_minutes", F.lit(0).cast("long")).alias("recovery_time_minutes"),
        (
            F.col("restore_window_minutes") - F.coalesce("critical_p95_minutes", F.lit(0.0))
        ).alias("restore_buffer_minutes"),
        now.cast("timestamp").alias("monitor_ts_utc"),
    )


def runs_from_logs(
    logs: Mapping[str, DataFrame], now: Column, hours: int | None = 24 * 7
) -> DataFrame:
    """Job runs rebuilt from log lines: ids and status by pattern, start, end, last status."""
    lines = union_all(
        [
            df.filter(_within("ts", now, hours) & F.col("text_payload").isNotNull()).select(
                "ts", "text_payload", F.lit(name).alias("source_component")
            )
            for name, df in logs.items()
        ]
    )
    text = F.lower("text_payload")
    parsed = lines.select(
        "ts",
        "source_component",
        F.coalesce(
            regex_or_null("text_payload", r"(?i)dag_id[=: ]+([a-zA-Z0-9_.-]+)"),
            regex_or_null("text_payload", r"(?i)\bdag[=: ]+([a-zA-Z0-9_.-]+)"),
            regex_or_null("text_payload", r"(?i)/dags/([a-zA-Z0-9_.-]+)"),
        ).alias("dag_id"),
        F.coalesce(
            regex_or_null("text_payload", r"(?i)run_id[=: ]+([^,\s]+)"),
            regex_or_null("text_payload", r"(?i)\brun[ _-]?id[=: ]+([^,\s]+)"),
        ).alias("run_id"),
        F.when(text.rlike("failed|failure"), "failed")
        .when(text.rlike("success|successful"), "success")
        .when(text.rlike("running|queued|start"), "running")
        .alias("hint"),
    ).filter("dag_id is not null")
    runs = parsed.groupBy("dag_id", "run_id").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.max_by("hint", F.when(F.col("hint").isNotNull(), F.struct("ts", "hint"))).alias("status"),
        F.max_by("source_component", F.struct("ts", "source_component")).alias("source_component"),
    )
    synthetic = F.concat(F.lit("unknown_"), F.date_format("start_ts", "yyyyMMddHH"))
    return runs.select(
        "dag_id",
        F.coalesce("run_id", synthetic).alias("run_id"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
        "start_ts",
        "end_ts",
        seconds_between(F.col("start_ts"), F.col("end_ts")).alias("duration_sec"),
        "source_component",
        now.cast("timestamp").alias("monitor_ts_utc"),
    )


# --- metric series -------------------------------------------------------------------------


@dataclass(frozen=True)
class Metric:
    """Metric name and the columns that may hold its value, in order of preference."""

    name: str
    columns: Sequence[str]


def metric_series(
    df: DataFrame,
    metrics: Sequence[Metric],
    labels: Mapping[str, str],
    latest_by: Sequence[str] = (),
    order: Sequence[str] = (),
    time: str | None = None,
) -> DataFrame:
    """Wide monitor rows -> (metric, labels, value), newest partition only.

    Labels are cut to 100 characters and dropped when blank; a missing or null value is 0.
    Of several points with one (metric, labels) the last by ``order`` stays.  With ``time`` every
    partition stays, and its time is the points' ``ts``.
    """
    rows = latest_partition(df, latest_by) if latest_by and time is None else df

    def value(m: Metric) -> Column:
        have = [F.col(c).cast("double") for c in m.columns if c in df.columns]
        return F.coalesce(*have, F.lit(0.0))

    def label(column: str) -> Column:
        text = F.col(column).cast("string") if column in df.columns else F.lit(None).cast("string")
        return F.substring(F.coalesce(text, F.lit("unknown")), 1, 100)

    tags = F.map_filter(
        F.create_map(*[x for k, c in sorted(labels.items()) for x in (F.lit(k[:100]), label(c))]),
        lambda _k, v: F.trim(v) != "",
    )
    points = F.array(*[F.struct(F.lit(m.name).alias("metric"), value(m).alias("value")) for m in metrics])
    ordering = [F.col(c).desc_nulls_last() for c in order if c in df.columns]
    at = [] if time is None else [F.col(time).cast("timestamp").alias("ts")]
    flat = rows.withColumn("labels", F.to_json(tags)).select(
        "labels", *at, *[c for c in order if c in df.columns], F.inline(points)
    )
    key = ["metric", "labels", *(["ts"] if at else [])]
    last = keep_first(flat, key, [*ordering, F.col("value").desc()])
    return last.select(*key, "value")


@dataclass(frozen=True)
class MetricSet:
    """The series of one monitor: ``{metric: columns that may hold it}`` under a prefix.

    ``summed`` adds up rows that share their labels, as a monitor with further keys has.
    """

    prefix: str
    metrics: Mapping[str, Sequence[str]]
    labels: Sequence[str]
    latest: Sequence[str] = ("hour_bucket", "monitor_ts_utc", "monitor_date_local")
    summed: bool = False

    def series(self, df: DataFrame, history: bool = False) -> DataFrame:
        """Points of the newest partition; with ``history`` those of all, with their ``ts``."""
        time = next((c for c in self.latest if c in df.columns), None) if history else None
        if history and time is None:
            raise ValueError(f"{self.prefix}: none of {list(self.latest)} tells the time of a row")
        if self.summed:
            newest = df if history else latest_partition(df, self.latest)
            columns = [c for names in self.metrics.values() for c in names if c in df.columns]
            by = [*self.labels, *([time] if time else [])]
            df = newest.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns])
        return metric_series(
            df,
            [Metric(f"{self.prefix}/{name}", columns) for name, columns in self.metrics.items()],
            {label: label for label in self.labels},
            () if self.summed else self.latest,
            time=time,
        )


def _same(*names: str) -> dict[str, list[str]]:
    return {n: [n] for n in names}


# Exported metrics; fixed names.
METRIC_SETS = {
    "watermark_health": MetricSet(
        "ops/watermark",
        {"mins_since_update": ["mins_since_watermark_update"], "mins_since_last_commit": ["mins_since_last_commit"]},
        ["table_name"],
        ["monitor_date_local", "updated_at"],
    ),
    "job_health": MetricSet(
        "ops/jobs",
        {
            "jobs_total": ["jobs_total", "total_jobs", "job_total"],
            "jobs_failed": ["jobs_failed", "failed_jobs", "job_failed"],
            "failed_ratio": ["failed_ratio", "job_failed_ratio"],
            "bytes_processed": ["bytes_processed", "total_bytes_processed"],
            "slot_ms": ["slot_ms", "total_slot_ms"],
            "p95_duration_sec": ["p95_duration_sec", "duration_p95_sec", "p95_sec"],
        },
        ["scope"],
    ),
    "component_health": MetricSet(
        "ops/component", _same("total_events", "error_events", "error_hints_text"), ["component"], summed=True
    ),
    "stream_health": MetricSet(
        "ops/stream",
        {
            "total_events": ["total_events", "events_total"],
            "error_events": ["error_events", "events_error"],
            "lag_or_error_hints": ["lag_or_error_hints", "error_hints"],
        },
        ["stream_id"],
    ),
    "object_ingest": MetricSet(
        "ops/objects",
        {
            "objects_created": ["objects_created", "created_objects"],
            "objects_deleted": ["objects_deleted", "deleted_objects"],
            "error_events": ["error_events", "events_error"],
        },
        ["bucket_name", "table_id"],
        summed=True,
    ),
    "scheduler_health": MetricSet(
        "ops/scheduler",
        _same(
            "total_events", "error_events", "http_4xx_5xx_events", "http_5xx_events", "success_events",
            "non_success_events", "success_ratio",
        ),
        ["job_id", "scheduler_location"],
    ),
    "critical_slo": MetricSet(
        "ops/dag",
        _same("critical_p95_minutes", "recovery_time_minutes", "restore_buffer_minutes", "restore_window_minutes"),
        ["dag_id"],
        ["monitor_date_local", "monitor_ts_utc"],
    ),
    "silver_freshness": MetricSet("ops/silver", _same("freshness_lag_minutes"), ["silver_table"], ()),
}


def monitor_series(monitors: Mapping[str, DataFrame]) -> DataFrame | None:
    """All series of the monitors that are there, by the names of ``METRIC_SETS``."""
    return union_all([kind.series(monitors[name]) for name, kind in METRIC_SETS.items() if name in monitors])


@dataclass(frozen=True)
class Limit:
    """Breach when ``value op bound`` held for ``minutes``.

    With ``other`` the bound is the value of that metric under the same labels.
    """

    metric: str
    op: str
    bound: float | None
    severity: str = "warning"
    minutes: int = 0
    other: str | None = None


# Alert thresholds; fixed values.
LIMITS = (
    Limit("ops/watermark/mins_since_update", ">", 180),
    Limit("ops/jobs/failed_ratio", ">", 0.05, minutes=15),
    Limit("ops/scheduler/success_ratio", "<", 0.95, minutes=30),
    Limit("ops/stream/error_events", ">", 0, minutes=15),
    Limit("ops/dag/restore_buffer_minutes", "<", 0, "critical"),
    Limit("ops/dag/recovery_time_minutes", ">", None, "critical", other="ops/dag/restore_window_minutes"),
    Limit("ops/silver/freshness_lag_minutes", ">", 120),
)


def series_history(monitors: Mapping[str, DataFrame]) -> DataFrame | None:
    """All points of the monitors with their time ``ts``, what limits that hold for a time need."""
    parts = [kind.series(monitors[name], history=True) for name, kind in METRIC_SETS.items() if name in monitors]
    return union_all(parts)


def breaches(
    series: DataFrame,
    limits: Sequence[Limit] = LIMITS,
    span_minutes: int = 0,
    max_gap_minutes: int | None = None,
    pending: bool = False,
) -> DataFrame:
    """Points beyond their limit.

    A limit with ``minutes`` needs the time ``ts`` of each point: a point is a breach if its series
    has been beyond the limit without a break for so long, from the first such point to this one.
    A point that stands for a period, such as an hour, adds ``span_minutes``.  A gap of more than
    ``max_gap_minutes`` between points is a break too.  Without times nothing is known to have
    held, so only limits without ``minutes`` are judged; ``pending`` judges points without times
    against all limits, and ``minutes`` tells how long a breach must hold before it fires.
    """
    timed = "ts" in series.columns
    judged_limits = [x for x in limits if timed or pending or not x.minutes]
    table = series.sparkSession.createDataFrame(
        [(x.metric, x.op, None if x.bound is None else float(x.bound), x.severity, x.minutes, x.other) for x in judged_limits],
        "metric string, op string, __bound double, severity string, minutes int, __other string",
    )
    same = ["labels", *(["ts"] if timed else [])]
    others = series.select(*same, F.col("metric").alias("__other"), F.col("value").alias("__value"))
    # A fixed list of a few limits.
    joined = (
        series.join(F.broadcast(table), "metric")
        .join(others.filter(F.col("__other").isin([x.other for x in judged_limits if x.other])), [*same, "__other"], "left")
        .withColumn("bound", F.coalesce("__bound", "__value"))
        .select(*series.columns, "op", "bound", "severity", "minutes")
    )
    over = F.coalesce(
        F.when(F.col("op") == ">", F.col("value") > F.col("bound")).otherwise(F.col("value") < F.col("bound")), F.lit(False)
    )
    if not timed:
        return joined.filter(over)
    key = ["metric", "labels", "op", "severity", "minutes"]
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    along = Window.partitionBy(*key).orderBy("__at")
    before = F.lag("__at").over(along)
    broken = ~F.col("__over")
    if max_gap_minutes is not None:
        broken = broken | F.coalesce(F.col("__at") - before > 60 * max_gap_minutes, F.lit(False))
    # Points between two breaks are one run; a break by a gap begins a run itself.
    runs = joined.withColumns({"__at": at, "__over": over}).withColumn("__broken", broken)
    runs = runs.withColumn("__run", F.count_if("__broken").over(along))
    since = F.min(F.when(F.col("__over"), F.col("__at"))).over(Window.partitionBy(*key, "__run"))
    held = F.col("__at") - since + 60 * span_minutes >= 60 * F.col("minutes")
    return runs.withColumn("__held", held).filter("__over and __held").select(
        *series.columns, "op", "bound", "severity", "minutes"
    )
