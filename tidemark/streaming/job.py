"""The alert job: messages -> alerts, and alerts -> history with cooldown.

Two queries with a durable hand-over between them, so either can restart from its own
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.messages import alert_json
from tidemark.streaming import alerts as al
from tidemark.streaming.alert_state import track_alerts
from tidemark.streaming.cooldown import COOLDOWN_SECONDS, cooldown_stream

ALERT_SCHEMA = (
    "source_table string, window_start timestamp, window_end timestamp, event_time timestamp, "
    "total_events long, alert_type string, severity string, alert_key string"
)


def detect(
    messages: DataFrame,
    threshold: int = al.SPIKE_THRESHOLD,
    length: str = "1 minute",
    lateness: str = "0 seconds",
    source_table: str = al.SOURCE_TABLE,
    now: Column | None = None,
    time: str = "event_time",
) -> DataFrame:
    """Alert JSON from a message stream; ``now`` stands in for a missing message time.

    Windows go by ``time``: the message's own ``event_time``, or a column that the source brings
    along, such as the ``publish_time`` of a queue.  An event whose window has closed, that is
    ended ``lateness`` before the newest time seen, is dropped.  The query's progress reports
    ``events_seen`` and ``events_counted``; what is between them when all windows are closed was
    late.
    """
    events = al.parse_messages(messages, source_table, now)
    events = events.observe("events", F.count(F.lit(1)).alias("events_seen"))
    counts = al.count_windows(events, length, time, lateness)
    counts = counts.observe("windows", F.sum("total_events").alias("events_counted"))
    return alert_json(al.spike_alerts(counts, threshold, source_table))


def read_alerts(raw: DataFrame) -> DataFrame:
    return raw.select(F.from_json("value", ALERT_SCHEMA).alias("a")).select("a.*")


def dispatch(
    raw_alerts: DataFrame,
    seconds: int = COOLDOWN_SECONDS,
    lateness: str = "0 seconds",
    keep_state: bool = False,
) -> DataFrame:
    """History rows from an alert stream, with the cooldown decision.

    With ``keep_state`` the query also keeps, for every key, what it saw and sent last
    (``alert_state.read_alert_state``).
    """
    keyed = al.with_alert_key(read_alerts(raw_alerts)).withWatermark("event_time", lateness)
    if keep_state:
        # The id is a function of the key; the state's payload is the alert as it came.
        decided = track_alerts(keyed.drop("alert_id"), cooldown=seconds).withColumn("alert_id", F.sha1("alert_key"))
    else:
        decided = cooldown_stream(keyed, seconds=seconds)
    return al.history_rows(decided, F.current_timestamp())
