"""Operations monitors: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.events import stage
from tidemark.catalog.registry import cte, query
from tidemark.plans import monitor as mon

NOW = "2024-02-01 00:00:00"
_NOW = f"timestamp '{NOW}'"
ALL_HOURS = None  # no bound: the whole event table
_ERR = "count(*) filter (where severity in ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')) as error_events"
_HOUR = "date_trunc('hour', ts)::varchar as hour_bucket"
COMPONENTS = ("airflow_scheduler", "airflow_triggerer", "airflow_webserver", "airflow_worker", "dag_processor_manager")


def _now():
    return F.lit(NOW).cast("timestamp")


def _logs(wh):
    return wh["ops_logs"].withColumn("ts", F.col("ts").cast("timestamp"))


def _by_component(wh, names=COMPONENTS):
    logs = _logs(wh)
    return {n: logs.filter(F.col("component") == f"component_{i}") for i, n in enumerate(names)}


def _watermarks(wh):
    return wh["events"].groupBy(F.col("event_type").alias("table_name")).agg(
        F.max("event_id").alias("last_lsn_num"),
        F.min("event_id").alias("last_inferred_seq"),
        F.max(F.col("ts").cast("timestamp")).alias("last_commit_ts"),
        F.lit("r1").alias("last_run_id"),
        (F.max(F.col("ts").cast("timestamp")) + F.expr("interval 1 hour")).alias("updated_at"),
    )


_MINUTES = "(epoch_us({b}) - epoch_us({a})) // 60000000"
cte(
    "watermark_rows",
    f"""
    select event_type as table_name, max(event_id) as last_lsn_num, min(event_id) as last_inferred_seq,
           max(ts)::varchar as last_commit_ts, 'r1' as last_run_id,
           (max(ts) + interval 1 hour)::varchar as updated_at,
           {_MINUTES.format(a='max(ts) + interval 1 hour', b=_NOW)} as mins_since_watermark_update,
           {_MINUTES.format(a='max(ts)', b=_NOW)} as mins_since_last_commit
    from events group by 1""",
)


@query("m01_watermark_health", "select '2024-02-01' as monitor_date_local, * from watermark_rows")
def _(wh):
    return mon.watermark_health(_watermarks(wh), _now())


@query(
    "m02_stage_run_quality",
    """select kind || '_cdc' as stage_table, '2024-01-30' as source_date_local, count(*) as rows_total,
              0::bigint as rows_lsn_num_null, 0.0::double as lsn_num_null_ratio,
              count(*) filter (where inferred) as rows_lsn_inferred,
              count(*) filter (where inferred) / count(*) as lsn_inferred_ratio,
              0::bigint as rows_commit_ts_null, max(ts)::varchar as max_commit_ts
       from staged where run = 'r2' group by kind""",
)
def _(wh):
    rows = stage(wh)
    kinds = ("signup", "purchase", "view", "click", "error")
    tables = {f"{k}_cdc": rows.filter(F.col("kind") == k) for k in kinds}
    out = mon.stage_run_quality({**tables, "other": rows}, "2024-01-30")
    return out.drop("max_ingest_ts")


cte(
    "silver_rows",
    f"""select 'silver_orders' as silver_table, count(*) as row_count, max(__commit_ts)::varchar as max_commit_ts,
               max(__lsn_num)::double as max_lsn_num, count(*) filter (where is_deleted) as soft_deleted_rows,
               count(*) filter (where is_deleted) / count(*) as soft_deleted_ratio,
               {_MINUTES.format(a='max(__commit_ts)', b=_NOW)} as freshness_lag_minutes from silver_orders
        union all
        select 'plain', count(*), max(__commit_ts)::varchar, max(__lsn_num)::double, 0, 0.0,
               {_MINUTES.format(a='max(__commit_ts)', b=_NOW)} from silver_orders""",
)


@query("m03_silver_freshness", "select * from silver_rows")
def _(wh):
    return mon.silver_freshness(_silver(wh), _now())


@query(
    "m04_duplicate_pk",
    f"""select '{NOW}' as monitor_ts_utc, '2024-02-01' as monitor_date_local, id::varchar as pk_value,
               count(*) as dup_count from silver_orders group by id having count(*) > 1""",
)
def _(wh):
    return mon.duplicate_keys(wh["silver_orders"], "id", _now())


cte(
    "job_hours",
    r"""
    select date_trunc('hour', creation_time) as hour_bucket, count(*) as jobs_total,
           count(error_result) as jobs_failed, count(error_result) / count(*) as failed_ratio,
           sum(total_bytes_processed)::bigint as bytes_processed, sum(total_slot_ms)::bigint as slot_ms,
           quantile_disc((epoch_us(end_time) - epoch_us(creation_time)) // 1000000, 0.95)
             as p95_duration_sec
    from warehouse_jobs
    where job_type = 'LOAD' or regexp_matches(lower(query), '\bmerge\b|\bcreate table\b|\binsert into\b|dbt')
    group by 1""",
)


@query("m05_job_health", "select * replace (hour_bucket::varchar as hour_bucket) from job_hours")
def _(wh):
    jobs = wh["warehouse_jobs"].withColumns(
        {c: F.col(c).cast("timestamp") for c in ("creation_time", "end_time")}
    )
    return mon.job_health(jobs, _now(), ALL_HOURS)


cte(
    "ingest_hours",
    rf"""select {_HOUR}, coalesce(nullif(regexp_extract(resource_name, 'buckets/([^/]+)/objects/', 1), ''),
                nullif(regexp_extract(request_url, '/b/([^/]+)/o/', 1), ''), 'unknown') as bucket_name,
               nullif(regexp_extract(resource_name, '/objects/cdc/([^/]+)/', 1), '') as table_id, method_name,
               count(*) as total_events,
               count(*) filter (where method_name = 'storage.objects.create') as objects_created,
               count(*) filter (where method_name = 'storage.objects.delete') as objects_deleted, {_ERR}
        from ops_logs group by all""",
)


@query("m06_object_ingest", "select * from ingest_hours")
def _(wh):
    return mon.object_ingest(_logs(wh), _now(), ALL_HOURS)


cte(
    "stream_lines",
    r"""
    select date_trunc('hour', ts) as h, severity,
           coalesce(nullif(regexp_extract(resource, '"stream_id"\s*:\s*"([^"]+)"', 1), ''),
             nullif(regexp_extract(json_payload, '"stream_id"\s*:\s*"([^"]+)"', 1), ''),
             nullif(regexp_extract(json_payload, '/streams/([^"/]+)', 1), ''),
             nullif(regexp_extract(text_payload, '/streams/([^/\s]+)', 1), ''), 'unknown') as stream_id,
           coalesce(json_extract_string(json_payload, '$.methodName'),
             json_extract_string(json_payload, '$.event_type')) as method,
           coalesce(json_extract_string(json_payload, '$.status.message'),
             json_extract_string(json_payload, '$.message'), text_payload, '') as status
    from ops_logs""",
)
cte(
    "stream_hours",
    f"""select h, stream_id, count(*) as total_events, {_ERR},
               count(*) filter (where regexp_matches(lower(status), 'lag|backlog|failed|error'))
                 as lag_or_error_hints,
               array_to_string(list_sort(list_distinct(list(method) filter (where method is not null)))[1:3],
                 '|') as methods_seen
        from stream_lines group by all""",
)


@query(
    "m07_stream_health",
    "select h::varchar as hour_bucket, * exclude (h) replace (coalesce(methods_seen, '') as methods_seen) from stream_hours",
)
def _(wh):
    found = mon.stream_health(_logs(wh), _now(), ALL_HOURS, methods=3)
    return found.withColumn("methods_seen", F.array_join("methods_seen", "|"))


_NAMES = ", ".join(f"'{n}'" for n in COMPONENTS)
cte(
    "component_hours",
    f"""select date_trunc('hour', ts) as h, ([{_NAMES}])[right(component, 1)::int + 1] as component,
               count(*) as total_events, {_ERR},
               count(*) filter (where regexp_matches(lower(coalesce(text_payload, '')),
                 'failed|error|exception|traceback|timeout')) as error_hints_text,
               0::bigint as error_hints_json from ops_logs group by all""",
)


@query("m08_component_health", "select h::varchar as hour_bucket, * exclude (h) from component_hours")
def _(wh):
    return mon.component_health(_by_component(wh), _now(), ALL_HOURS)


@query(
    "m09_text_error_hints",
    f"""select {_HOUR}, count(*) as total_events, {_ERR},
               count(*) filter (where regexp_matches(lower(coalesce(text_payload, '')),
                 'failed|error|denied|permission')) as text_error_hints,
               0::bigint as json_error_hints from ops_logs group by 1""",
)
def _(wh):
    return mon.text_error_hints(_logs(wh), _now(), ALL_HOURS)


cte(
    "scheduler_hours",
    f"""select date_trunc('hour', ts) as h, location as scheduler_location, job_id, count(*) as total_events,
               {_ERR}, count(*) filter (where http_status >= 400) as http_4xx_5xx_events,
               count(*) filter (where http_status >= 500) as http_5xx_events,
               count(*) filter (where status = 'SUCCESS') as success_events,
               count(*) filter (where status is distinct from 'SUCCESS') as non_success_events,
               count(*) filter (where status = 'SUCCESS') / count(*) as success_ratio,
               max(ts)::varchar as latest_event_ts from ops_logs group by all""",
)


@query("m10_scheduler_health", "select h::varchar as hour_bucket, * exclude (h) from scheduler_hours")
def _(wh):
    return mon.scheduler_health(_logs(wh), _now(), ALL_HOURS)


WINDOWS = {"signup": 180, "purchase": 120, "absent": 180}
cte(
    "slo_rows",
    f"""
    with runs as (
      select dag_id, run_id, lower(coalesce(status, 'unknown')) as status, start_ts, end_ts,
             coalesce(duration_sec, (epoch_us(end_ts) - epoch_us(start_ts)) // 1000000) as duration_sec
      from dag_runs where start_ts >= {_NOW} - interval 30 day),
    p95 as (select dag_id, quantile_disc(duration_sec, 0.95) / 60.0 as critical_p95_minutes
            from runs where status = 'success' and start_ts >= {_NOW} - interval 14 day group by 1),
    healed as (select f.dag_id, f.run_id, f.end_ts, min(s.start_ts) as nxt
               from runs f join runs s on s.dag_id = f.dag_id and s.status = 'success'
                 and s.start_ts > f.end_ts
               where f.status = 'failed' and f.end_ts >= {_NOW} - interval 14 day group by all),
    recovery as (select dag_id, quantile_disc((epoch_us(nxt) - epoch_us(end_ts)) // 60000000, 0.95) as r
                 from healed group by 1)
    select '2024-02-01' as monitor_date_local, d.dag_id, d.w as restore_window_minutes,
           p.critical_p95_minutes::double as critical_p95_minutes,
           coalesce(r.r, 0) as recovery_time_minutes,
           (d.w - coalesce(p.critical_p95_minutes, 0))::double as restore_buffer_minutes,
           '{NOW}' as monitor_ts_utc
    from (values {', '.join(f"('{k}', {v}::bigint)" for k, v in WINDOWS.items())}) d(dag_id, w)
    left join p95 p on p.dag_id = d.dag_id left join recovery r on r.dag_id = d.dag_id""",
)


def _slo(wh):
    runs = wh["dag_runs"].withColumns(
        {c: F.col(c).cast("timestamp") for c in ("start_ts", "end_ts")}
    )
    return mon.critical_slo(runs, WINDOWS, _now())


@query("m11_critical_slo", "select * from slo_rows")
def _(wh):
    return _slo(wh)


@query(
    "m12_runs_from_logs",
    r"""
    with p as (
      select ts, case right(component, 1) when '0' then 'airflow_scheduler' else 'airflow_worker' end as c,
             coalesce(nullif(regexp_extract(text_payload, '(?i)dag_id[=: ]+([a-zA-Z0-9_.-]+)', 1), ''),
               nullif(regexp_extract(text_payload, '(?i)\bdag[=: ]+([a-zA-Z0-9_.-]+)', 1), ''),
               nullif(regexp_extract(text_payload, '(?i)/dags/([a-zA-Z0-9_.-]+)', 1), '')) as dag_id,
             coalesce(nullif(regexp_extract(text_payload, '(?i)run_id[=: ]+([^,\s]+)', 1), ''),
               nullif(regexp_extract(text_payload, '(?i)\brun[ _-]?id[=: ]+([^,\s]+)', 1), '')) as run_id,
             case when regexp_matches(lower(text_payload), 'failed|failure') then 'failed'
                  when regexp_matches(lower(text_payload), 'success') then 'success'
                  when regexp_matches(lower(text_payload), 'running|queued|start') then 'running' end as hint
      from ops_logs where text_payload is not null and right(component, 1) in ('0', '1')),
    a as (select dag_id, run_id, min(ts) as s, max(ts) as e, arg_max(hint, ts) filter (where hint is not null)
                   as status, arg_max(c, ts) as source_component
          from p where dag_id is not null group by dag_id, run_id)
    select dag_id, coalesce(run_id, 'unknown_' || strftime(s, '%Y%m%d%H')) as run_id,
           coalesce(status, 'unknown') as status, s::varchar as start_ts, e::varchar as end_ts,
           (epoch_us(e) - epoch_us(s)) // 1000000 as duration_sec, source_component from a""",
)
def _(wh):
    logs = _by_component(wh, ("airflow_scheduler", "airflow_worker"))
    return mon.runs_from_logs(logs, _now(), ALL_HOURS).drop("monitor_ts_utc")


# --- series and breaches -------------------------------------------------------------------

def _silver(wh):
    silver = wh["silver_orders"]
    return {"silver_orders": silver, "plain": silver.drop("is_deleted"), "users": wh["users"]}


def _series(wh):
    jobs = wh["warehouse_jobs"].withColumns(
        {c: F.col(c).cast("timestamp") for c in ("creation_time", "end_time")}
    )
    logs, now = _logs(wh), _now()
    return mon.monitor_series(
        {
            "watermark_health": mon.watermark_health(_watermarks(wh), now).drop("updated_at"),
            "job_health": mon.job_health(jobs, now, ALL_HOURS).withColumn("scope", F.lit("all")),
            "component_health": mon.component_health(_by_component(wh), now, ALL_HOURS),
            "stream_health": mon.stream_health(logs, now, ALL_HOURS),
            "object_ingest": mon.object_ingest(logs, now, ALL_HOURS),
            "scheduler_health": mon.scheduler_health(logs, now, ALL_HOURS),
            "critical_slo": _slo(wh),
            "silver_freshness": mon.silver_freshness(_silver(wh), now),
        }
    )


def _wide(source: str, labels: str, metrics: dict[str, str], where: str = "true") -> str:
    return " union all ".join(
        f"select '{m}' as metric, {labels} as labels, coalesce({v}, 0)::double as value from {source} where {where}"
        for m, v in metrics.items()
    )


cte(
    "series_rows",
    " union all ".join(
        [
            _wide(
                "watermark_rows",
                """'{"table_name":"' || table_name || '"}'""",
                {
                    "ops/watermark/mins_since_update": "mins_since_watermark_update",
                    "ops/watermark/mins_since_last_commit": "mins_since_last_commit",
                },
            ),
            _wide(
                "job_hours",
                """'{"scope":"all"}'""",
                {
                    "ops/jobs/jobs_total": "jobs_total",
                    "ops/jobs/jobs_failed": "jobs_failed",
                    "ops/jobs/bytes_processed": "bytes_processed",
                    "ops/jobs/slot_ms": "slot_ms",
                    "ops/jobs/failed_ratio": "failed_ratio",
                    "ops/jobs/p95_duration_sec": "p95_duration_sec",
                },
                "hour_bucket = (select max(hour_bucket) from job_hours)",
            ),
            _wide(
                "component_hours",
                """'{"component":"' || component || '"}'""",
                {f"ops/component/{m}": m for m in ("total_events", "error_events", "error_hints_text")},
                "h = (select max(h) from component_hours)",
            ),
            _wide(
                "stream_hours",
                """'{"stream_id":"' || stream_id || '"}'""",
                {f"ops/stream/{m}": m for m in ("total_events", "error_events", "lag_or_error_hints")},
                "h = (select max(h) from stream_hours)",
            ),
            _wide(
                "(select bucket_name, table_id, sum(objects_created) as objects_created, sum(objects_deleted) as "
                "objects_deleted, sum(error_events) as error_events from ingest_hours where hour_bucket = "
                "(select max(hour_bucket) from ingest_hours) group by all)",
                """'{"bucket_name":"' || bucket_name || '","table_id":"' || coalesce(table_id, 'unknown') || '"}'""",
                {f"ops/objects/{m}": m for m in ("objects_created", "objects_deleted", "error_events")},
            ),
            _wide(
                "silver_rows",
                """'{"silver_table":"' || silver_table || '"}'""",
                {"ops/silver/freshness_lag_minutes": "freshness_lag_minutes"},
            ),
            _wide(
                "scheduler_hours",
                """'{"job_id":"' || job_id || '","scheduler_location":"' || scheduler_location || '"}'""",
                {
                    "ops/scheduler/success_ratio": "success_ratio",
                    **{
                        f"ops/scheduler/{m}": m
                        for m in ("total_events", "error_events", "http_4xx_5xx_events", "http_5xx_events",
                                  "success_events", "non_success_events")
                    },
                },
                "h = (select max(h) from scheduler_hours)",
            ),
            _wide(
                "slo_rows",
                """'{"dag_id":"' || dag_id || '"}'""",
                {
                    "ops/dag/critical_p95_minutes": "critical_p95_minutes",
                    "ops/dag/restore_buffer_minutes": "restore_buffer_minutes",
                    "ops/dag/recovery_time_minutes": "recovery_time_minutes",
                    "ops/dag/restore_window_minutes": "restore_window_minutes",
                },
            ),
        ]
    ),
)


@query("m13_metric_series", "select * from series_rows")
def _(wh):
    return _series(wh)


@query(
    "m14_threshold_breaches",
    """select s.*, op, bound, severity, minutes from series_rows s join (values
         ('ops/watermark/mins_since_update', '>', 180.0::double, 'warning', 0::bigint),
         ('ops/jobs/failed_ratio', '>', 0.05, 'warning', 15),
         ('ops/scheduler/success_ratio', '<', 0.95, 'warning', 30),
         ('ops/stream/error_events', '>', 0, 'warning', 15),
         ('ops/silver/freshness_lag_minutes', '>', 120, 'warning', 0),
         ('ops/dag/restore_buffer_minutes', '<', 0, 'critical', 0)) l(metric, op, bound, severity, minutes)
         using (metric)
       where (op = '>' and value > bound) or (op = '<' and value < bound)
       union all
       select 'ops/dag/recovery_time_minutes', '{"dag_id":"' || dag_id || '"}', recovery_time_minutes::double,
              '>', restore_window_minutes::double, 'critical', 0
       from slo_rows where recovery_time_minutes > restore_window_minutes""",
)
def _(wh):
    """The newest points against every limit; ``minutes`` tells how long a breach must hold to fire."""
    return mon.breaches(_series(wh), pending=True)


def _held_sql(points: str, span: int) -> str:
    """Points beyond their limit since at least its minutes, by the start of the run they are in."""
    return f"""
       with points as ({points}),
       judged as (select *, case when op = '>' then value > bound else value < bound end as over from points),
       runs as (select *, count(*) filter (not over) over (partition by metric, labels, minutes order by ts) as run from judged),
       held as (select *, min(ts) filter (over) over (partition by metric, labels, minutes, run) as since from runs)
       select metric, labels, ts::varchar as ts, value, op, bound, severity, minutes from held
       where over and ts + {span} * interval 1 minute >= since + minutes * interval 1 minute"""


@query(
    "m14_sustained_breaches",
    _held_sql(
        """select 'ops/jobs/failed_ratio' as metric, event_type as labels, date_trunc('minute', ts) as ts,
                  count(*) filter (where value > 20) / count(*) as value, '>' as op, 0.05::double as bound,
                  'warning' as severity, 15::bigint as minutes from events group by all""",
        0,
    ),
)
def _(wh):
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    points = wh["events"].groupBy(F.col("event_type").alias("labels"), minute.alias("ts")).agg(
        F.try_divide(F.count_if(F.col("value") > 20), F.count(F.lit(1))).alias("value")
    )
    series = points.select(F.lit("ops/jobs/failed_ratio").alias("metric"), "labels", "ts", "value")
    return mon.breaches(series)


#: Limits on hourly monitors: held for two, three and six hours.
HOURLY_LIMITS = (
    mon.Limit("ops/jobs/failed_ratio", ">", 0.05, minutes=120),
    mon.Limit("ops/scheduler/success_ratio", "<", 0.6, minutes=180),
    mon.Limit("ops/stream/error_events", ">", 0, minutes=360),
)


@query(
    "m14_held_breaches",
    _held_sql(
        """select 'ops/jobs/failed_ratio' as metric, '{"scope":"all"}' as labels, hour_bucket as ts, failed_ratio::double as value,
                  '>' as op, 0.05::double as bound, 'warning' as severity, 120::bigint as minutes from job_hours
           union all
           select 'ops/scheduler/success_ratio', '{"job_id":"' || job_id || '","scheduler_location":"' || scheduler_location || '"}',
                  h, coalesce(success_ratio, 0)::double, '<', 0.6, 'warning', 180 from scheduler_hours
           union all
           select 'ops/stream/error_events', '{"stream_id":"' || stream_id || '"}', h, coalesce(error_events, 0)::double,
                  '>', 0, 'warning', 360 from stream_hours""",
        60,
    ),
)
def _(wh):
    """Real monitor rows of all hours: a breach shorter than its limit does not fire."""
    jobs = wh["warehouse_jobs"].withColumns(
        {c: F.col(c).cast("timestamp") for c in ("creation_time", "end_time")}
    )
    logs, now = _logs(wh), _now()
    history = mon.series_history(
        {
            "job_health": mon.job_health(jobs, now, ALL_HOURS).withColumn("scope", F.lit("all")),
            "scheduler_health": mon.scheduler_health(logs, now, ALL_HOURS),
            "stream_health": mon.stream_health(logs, now, ALL_HOURS),
        }
    )
    return mon.breaches(history, HOURLY_LIMITS, span_minutes=60)
