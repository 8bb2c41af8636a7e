"""Alert stream operators on the event table: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import cte, query
from tidemark.session import fresh_path, tune
from tidemark.sources import folder_queue
from tidemark.sources.messages import alert_json, read_published_files
from tidemark.streaming import alerts as al
from tidemark.streaming.cooldown import cooldown_batch
from tidemark.streaming.alert_state import ROCKSDB, read_alert_state, track_alerts
from tidemark.streaming.job import detect, dispatch, read_alerts
from tidemark.streaming.progress import Progress, run_available

NOW = "2024-01-15 12:00:00"
LENGTH, THRESHOLD = "1 hour", 3
TABLE = "public.clinic_bookings"


def _now():
    return F.lit(NOW).cast("timestamp")


cte(
    "created",
    f"""
    select event_id, case when event_id % 23 = 0 then timestamp '{NOW}'
                          else date_trunc('millisecond', ts) end as event_time,
           case when event_id % 11 = 0 then '{TABLE}' else 'public.Clinic_Bookings' end as source_table
    from events
    where event_id % 17 <> 0 and event_type not in ('error', 'view') and event_id % 19 <> 0
      and (event_id % 13 <> 0 or event_id % 11 = 0)""",
)
cte(
    "hour_counts",
    """select date_trunc('hour', event_time) as window_start,
              date_trunc('hour', event_time) + interval 1 hour as window_end,
              count(*) as total_events from created group by 1""",
)
cte(
    "hour_alerts",
    f"""select '{TABLE}' as source_table, window_start, window_end, window_end as event_time, total_events,
               'booking_spike' as alert_type,
               case when total_events >= {2 * THRESHOLD} then 'critical' else 'warning' end as severity,
               'booking_spike|{TABLE}' as alert_key
        from hour_counts where total_events >= {THRESHOLD}""",
)
_ALERT_OUT = """source_table, window_start::varchar as window_start, window_end::varchar as window_end,
  event_time::varchar as event_time, total_events, alert_type, severity, alert_key"""


def _events(wh):
    return al.parse_messages(wh["messages"], now=_now())


def _alerts(wh):
    return al.spike_alerts(al.count_windows(_events(wh), LENGTH), THRESHOLD)


@query("a16_parse_json_source", "select event_id from events where event_id % 17 <> 0")
def _(wh):
    parsed = F.from_json("value", "payload string, op string", {"mode": "PERMISSIVE"})
    rows = wh["messages"].select("event_id", parsed.alias("m"))
    return rows.filter("m.payload is not null or m.op is not null").select("event_id")


@query("n01_event_filter", "select event_id, 'c' as op, source_table from created")
def _(wh):
    return _events(wh).select("event_id", "op", "source_table")


@query("n02_event_time", "select event_id, event_time::varchar as event_time from created")
def _(wh):
    return _events(wh).select("event_id", "event_time")


@query(
    "n03_window_counts",
    """select window_start::varchar as window_start, window_end::varchar as window_end, total_events
       from hour_counts""",
)
def _(wh):
    return al.count_windows(_events(wh), LENGTH)


@query("n04_spike_alerts", f"select {_ALERT_OUT} from hour_alerts")
def _(wh):
    return _alerts(wh)


# One alert per user and ten-minute window with at least one event.
cte(
    "user_alerts",
    """select 'u' || user_id as alert_key, time_bucket(interval 10 minute, ts) as event_time,
              count(*) as total_events from events group by all""",
)
_COOLDOWN = 6 * 3600
cte("sent_chain", "select alert_key, min(event_time) as t from user_alerts group by 1")


@query(
    "n05_cooldown",
    f"""
    with recursive chain as (
      select alert_key, t from sent_chain
      union
      select c.alert_key, (select min(u.event_time) from user_alerts u where u.alert_key = c.alert_key
                             and u.event_time >= c.t + interval {_COOLDOWN} second) as t
      from chain c where t is not null)
    select u.alert_key, u.event_time::varchar as event_time, u.total_events,
           exists (select 1 from chain c where c.alert_key = u.alert_key
                   and c.t = u.event_time) as emitted
    from user_alerts u""",
)
def _(wh):
    window = F.window(F.col("ts").cast("timestamp"), "10 minutes")["start"]
    key = F.concat(F.lit("u"), "user_id")
    alerts = wh["events"].groupBy(key.alias("alert_key"), window.alias("event_time")).agg(
        F.count(F.lit(1)).alias("total_events")
    )
    return cooldown_batch(alerts, seconds=_COOLDOWN)


@query(
    "n06_alert_keys",
    """select event_id, alert_type, source_table, key as alert_key, sha1(key) as alert_id from (
         select event_id, case when event_type <> 'view' then event_type end as alert_type,
                'public.t' || user_id % 3 as source_table,
                case when event_id % 4 = 0 then 'own' when true then
                  coalesce(case when event_type <> 'view' then event_type end, 'unknown') || '|public.t'
                  || user_id % 3 end as key from events)""",
)
def _(wh):
    n = F.col("event_id")
    alerts = wh["events"].select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("alert_type"),
        F.concat(F.lit("public.t"), F.col("user_id") % 3).alias("source_table"),
        F.when(n % 4 == 0, "own").when(n % 4 == 1, "").alias("alert_key"),
    )
    return al.with_alert_key(alerts)


@query(
    "n08_cancel_ratio",
    """select 'public.clinic_bookings' as source_table, date_trunc('hour', ts)::varchar as window_start,
              (date_trunc('hour', ts) + interval 1 hour)::varchar as window_end,
              (date_trunc('hour', ts) + interval 1 hour)::varchar as event_time, count(*) as total_events,
              count(*) filter (where event_type = 'error') / count(*) as cancel_ratio,
              'cancel_ratio' as alert_type, 'warning' as severity,
              'cancel_ratio|public.clinic_bookings' as alert_key
       from events group by date_trunc('hour', ts)
       having count(*) filter (where event_type = 'error') / count(*) > 0.3""",
)
def _(wh):
    events = wh["events"].withColumn("event_time", F.col("ts").cast("timestamp"))
    return al.cancel_ratio_alerts(events, F.col("event_type") == "error", 0.3, LENGTH)


#: State partitions of the two checks: fixed for the life of a checkpoint, so a parameter.
STATE_PARTITIONS = 8


def _stream_session(spark):
    """A session of its own for streams, so that their settings touch no other query."""
    own = tune(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(STATE_PARTITIONS))
    return own


def _stream_alerts(wh) -> tuple:
    """Messages as a file stream, a few files a trigger, through the detector into an alert folder.

    The files of a replay come in no order of time, so the allowed lateness is the span of the
    messages.  A closing message far in the future, sent in a run of its own on the same
    checkpoint once all messages are in, moves the watermark past the last real window.
    """
    messages = wh["messages"]
    spark, path = messages.sparkSession, fresh_path(messages.sparkSession, "stream")
    times = wh["events"].agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b")).first()
    span = f"{int((times.b - times.a).total_seconds()) + 3600} seconds" if times.a else "0 seconds"
    messages.select("value").repartition(4).write.text(f"{path}/in")
    stream = _stream_session(spark)

    def run() -> None:
        arriving = stream.readStream.option("maxFilesPerTrigger", 2).text(f"{path}/in")
        run_available(detect(arriving, THRESHOLD, LENGTH, lateness=span, now=_now()), f"{path}/alerts", "text")

    run()
    closing = '{"op":"c","ts_ms":4102444800000,"after":{"id":0}}'
    spark.range(1).select(F.lit(closing).alias("value")).write.mode("append").text(f"{path}/in")
    run()
    return spark, path, span


# Messages come with the time a queue published them, in deliveries of a week each.  Some come
# one or two deliveries late; windows go by publish time and close ``LATENESS`` after it.
LATENESS_DAYS, DELIVERY_DAYS = 2, 7
cte(
    "published",
    f"""
    select event_id, date_trunc('millisecond', ts) + event_id % 90 * interval 1 minute as sent,
           greatest(0, least(4, date_diff('day', (select min(ts)::date from events), ts::date) // {DELIVERY_DAYS}))
             + case event_id % 10 when 3 then 1 when 7 then 2 else 0 end as delivery
    from events
    where event_id % 17 <> 0 and event_type not in ('error', 'view') and event_id % 19 <> 0
      and (event_id % 13 <> 0 or event_id % 11 = 0)""",
)
cte(
    "judged_late",
    f"""
    select p.*, date_trunc('hour', sent) as hour,
           coalesce(date_trunc('hour', sent) + interval 1 hour
                    <= (select max(q.sent) from published q where q.delivery < p.delivery) - interval {LATENESS_DAYS} day,
                    false) as late
    from published p""",
)


def _late_stream(wh) -> tuple:
    """Deliveries through the detector, one run each on one checkpoint, and a closing message."""
    messages, events = wh["messages"], wh["events"]
    spark, path = messages.sparkSession, fresh_path(messages.sparkSession, "late")
    first = events.agg(F.to_date(F.min("ts")).alias("d")).first().d
    n = F.col("event_id")
    minutes = F.make_interval(mins=(n % 90).cast("int"))
    week = F.floor(F.datediff(F.to_date("ts"), F.lit(first)) / DELIVERY_DAYS)
    shift = F.when(n % 10 == 3, 1).when(n % 10 == 7, 2).otherwise(0)
    delivery = F.greatest(F.lit(0), F.least(F.lit(4), week)) + shift
    timed = events.select("event_id", (F.date_trunc("millisecond", "ts").cast("timestamp") + minutes).alias("publish_time"), delivery.cast("int").alias("delivery"))
    arriving = messages.select("event_id", "value").join(timed, "event_id").select("value", "publish_time", "delivery")
    arriving.write.partitionBy("delivery").parquet(f"{path}/all")
    closing = '{"op":"c","ts_ms":4102444800000,"after":{"id":0}}'
    end = F.lit("2100-01-01").cast("timestamp")
    last = spark.range(1).select(F.lit(closing).alias("value"), end.alias("publish_time"))
    stream, progress = _stream_session(spark), Progress()
    for i in range(8):
        one = last if i == 7 else spark.read.parquet(f"{path}/all").filter(F.col("delivery") == i).drop("delivery")
        one.write.mode("append").parquet(f"{path}/in")
        found = detect(
            read_published_files(stream, f"{path}/in"), THRESHOLD, LENGTH, f"{LATENESS_DAYS} days", now=_now(), time="publish_time"
        )
        run_available(found, f"{path}/alerts", "text", progress)
    return read_alerts(spark.read.text(f"{path}/alerts")), progress


@query(
    "n07_stream_alerts_late_data",
    f"""select hour::varchar as window_start, count(*) as total_events from judged_late where not late
        group by hour having count(*) >= {THRESHOLD}""",
)
def _(wh):
    """Windows by publish time, without the messages that came after their window had closed."""
    found, _ = _late_stream(wh)
    return found.select("window_start", "total_events")


@query(
    "n07_late_dropped",
    """select count(*) as events_seen, count(*) filter (not late) as events_counted,
              count(*) filter (late) as events_late, count(*) filter (late) > 0 as state_rejected from judged_late""",
)
def _(wh):
    """Late messages as the query's progress reports them; the closing one is left out."""
    found, progress = _late_stream(wh)
    spark = found.sparkSession
    seen, late = progress.observed["events_seen"] - 1, progress.late_events - 1
    return spark.range(1).select(
        F.lit(seen).cast("long").alias("events_seen"), F.lit(seen - late).cast("long").alias("events_counted"),
        F.lit(late).cast("long").alias("events_late"), F.lit(progress.late_state_rows > 0).alias("state_rejected"),
    )


@query(
    "n05_alert_state",
    f"""
    with recursive chain as (
      select alert_key, t from sent_chain
      union
      select c.alert_key, (select min(u.event_time) from user_alerts u where u.alert_key = c.alert_key
                             and u.event_time >= c.t + interval {_COOLDOWN} second) as t
      from chain c where t is not null)
    select u.alert_key, max(u.event_time)::varchar as last_event_time,
           (select max(c.t) from chain c where c.alert_key = u.alert_key)::varchar as last_sent_at,
           arg_max(case when u.total_events >= 2 then 'critical' else 'warning' end, u.event_time) as severity,
           arg_max(u.total_events, u.event_time) as last_total_events, count(*) as alerts_seen,
           count(*) - (select count(c.t) from chain c where c.alert_key = u.alert_key) as alerts_suppressed
    from user_alerts u group by u.alert_key""",
)
def _(wh):
    """Two runs on one checkpoint, then the state of every key read back from it."""
    events = wh["events"]
    spark, path = events.sparkSession, fresh_path(events.sparkSession, "alert-state")
    window = F.window(F.col("ts").cast("timestamp"), "10 minutes")["start"]
    alerts = events.groupBy(F.concat(F.lit("u"), "user_id").alias("alert_key"), window.alias("event_time")).agg(
        F.count(F.lit(1)).alias("total_events")
    )
    alerts = alerts.withColumn("severity", F.when(F.col("total_events") >= 2, "critical").otherwise("warning"))
    alerts.withColumn("run", F.when(F.dayofmonth("event_time") <= 15, 1).otherwise(2)).write.partitionBy("run").parquet(f"{path}/all")
    stream = _stream_session(spark)
    stream.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    for run in (1, 2):
        spark.read.parquet(f"{path}/all").filter(F.col("run") == run).drop("run").write.mode("append").parquet(f"{path}/in")
        arriving = stream.readStream.schema(alerts.schema).parquet(f"{path}/in").withWatermark("event_time", "40 days")
        run_available(track_alerts(arriving, cooldown=_COOLDOWN), f"{path}/history", "parquet")
    state = read_alert_state(stream, f"{path}/history-checkpoint")
    return state.select(
        "alert_key", "last_event_time", "last_sent_at", "severity",
        F.get_json_object("last_payload", "$.total_events").cast("long").alias("last_total_events"),
        "alerts_seen", "alerts_suppressed",
    )


@query("a16_queue_to_sent_alerts", f"select {_ALERT_OUT} from hour_alerts")
def _(wh):
    """Deliveries of a folder queue through the detector into a sink that commits each batch once."""
    messages, events = wh["messages"], wh["events"]
    spark, path = messages.sparkSession, fresh_path(messages.sparkSession, "queue")
    times = events.agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b")).first()
    span = f"{int((times.b - times.a).total_seconds()) + 3600} seconds" if times.a else "0 seconds"
    for i in range(2):
        folder_queue.publish(messages.filter(F.col("event_id") % 2 == i), f"{path}/queue")
    stream = _stream_session(spark)

    def run() -> None:
        found = detect(folder_queue.read_queue(stream, f"{path}/queue"), THRESHOLD, LENGTH, lateness=span, now=_now())
        folder_queue.send(found, f"{path}/sent", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    run()
    # The first closing message moves the watermark, the second brings the batch that closes windows.
    closing = '{"op":"c","ts_ms":4102444800000,"after":{"id":0}}'
    for _ in range(2):
        folder_queue.publish(spark.range(1).select(F.lit(closing).alias("value")), f"{path}/queue")
        run()
    return read_alerts(folder_queue.read_sent(spark, f"{path}/sent"))


cte("first_sent", "select min(window_start) as t from hour_alerts")


@query(
    "a17_alert_history",
    f"""
    with recursive chain as (
      select t from first_sent union
      select (select min(a.window_start) from hour_alerts a where a.window_start >= c.t + interval 4 hour)
      from chain c where t is not null)
    select sha1('booking_spike|{TABLE}') as alert_id, 'booking_spike|{TABLE}' as alert_key,
           'booking_spike' as alert_type, '{TABLE}' as source_table,
           (window_start + interval 1 hour)::varchar as event_time,
           window_start in (select t from chain where t is not null) as emitted
    from hour_alerts""",
)
def _(wh):
    spark, path, span = _stream_alerts(wh)
    raw = _stream_session(spark).readStream.text(f"{path}/alerts")
    run_available(dispatch(raw, seconds=4 * 3600, lateness=span), f"{path}/history", "parquet")
    return spark.read.parquet(f"{path}/history").select(
        "alert_id", "alert_key", "alert_type", "source_table", "event_time", "emitted"
    )


@query(
    "a17_alert_json",
    """select event_time::varchar as event_time, '{"severity":"' || severity || '","total_events":'
              || total_events || '}' as value from hour_alerts""",
)
def _(wh):
    # The time is taken back out of the message that the sink gets.
    sent = alert_json(_alerts(wh).select("event_time", "severity", "total_events"))
    return sent.select(
        F.get_json_object("value", "$.event_time").cast("timestamp").cast("string").alias("event_time"),
        F.regexp_replace("value", '"event_time":"[^"]*",', "").alias("value"),
    )
