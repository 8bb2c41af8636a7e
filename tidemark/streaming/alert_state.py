"""Alert state per key: what was seen last and sent last, kept beside the cooldown decision.

Each alert, sent or suppressed, updates its key's state: times of the last alert and the last
send, the last payload and severity, and how many alerts came and were held back.  The state is
a table of its own that can be read back from the checkpoint at any time.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.cooldown import COOLDOWN_SECONDS, _with_flag

STATE_VARIABLE = "alert"
#: Times are microseconds since 1970, which no time zone of a worker can shift.
_STATE = (
    "alert_type string, severity string, source_table string, last_event_time long, last_sent_at long, "
    "last_payload string, alerts_seen long, alerts_suppressed long"
)
_TIMES = ("last_event_time", "last_sent_at")
_EPOCH, _MICROSECOND = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc), dt.timedelta(microseconds=1)
_NAMED = ("alert_type", "severity", "source_table")
#: State that Python processors keep needs this store.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class AlertState(StatefulProcessor):
    """One value state for each alert key; ``time`` orders the alerts of a micro-batch.

    In event time a timer forgets a key that was silent for ``retention`` seconds; in
    processing time the state's own TTL does.  Alerts come as rows: a frame for each key and
    micro-batch costs more than all the rest.
    """

    def __init__(self, time: str, cooldown: int, retention: int, event_time: bool):
        self.time, self.event_time = time, event_time
        self.cooldown, self.retention = cooldown * 1_000_000, retention * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(STATE_VARIABLE, _STATE, None if self.event_time else self.retention // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.state.get()
        last_event, last_sent, seen, held = (old[3], old[4], old[6], old[7]) if old else (None, None, 0, 0)
        # One key's alerts of one micro-batch: at most one per window.
        batch = sorted(((_micros(row[self.time]), row) for row in rows), key=lambda x: (x[0] is None, x[0]))
        flagged = Row(*batch[0][1].__fields__, "emitted")
        newest, out = None, []
        for at, row in batch:
            # One without a time comes last: held back after a send, and never the newest.
            sent = last_sent is None or (at is not None and at >= last_sent + self.cooldown)
            last_sent = at if sent else last_sent
            seen, held = seen + 1, held + (not sent)
            if at is not None and (last_event is None or at >= last_event):  # an older one that comes late is no news
                last_event, newest = at, row
            out.append(flagged(*row, sent))
        if last_event is None:  # no alert of this key ever had a time
            yield from out
            return
        if newest is None:
            self.state.update((*old[:3], last_event, last_sent, old[5], seen, held))
        else:
            alert = newest.asDict()
            named = [str(alert.get(c) or "unknown") for c in _NAMED]
            self.state.update((*named, last_event, last_sent, _payload(alert), seen, held))
        if self.event_time and (old is None or old[3] != last_event):
            if old:
                self.handle.deleteTimer(_millis(old[3] + self.retention))
            self.handle.registerTimer(_millis(last_event + self.retention))
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def _micros(t: dt.datetime | None) -> int | None:
    return None if t is None else ((t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)) - _EPOCH) // _MICROSECOND


def _millis(micros: int) -> int:
    return micros // 1000


def _payload(alert: dict) -> str:
    """The alert as compact JSON, absent values left out; times as the session's clock shows them."""
    out = {}
    for name, value in alert.items():
        if value is None or value != value:
            continue
        out[name] = value.replace(tzinfo=None).isoformat() if isinstance(value, dt.datetime) else value
    return json.dumps(out, separators=(",", ":"), ensure_ascii=False)


def track_alerts(
    alerts: DataFrame,
    key: str = "alert_key",
    time: str = "event_time",
    cooldown: int = COOLDOWN_SECONDS,
    retention: int = 30 * 24 * 3600,
    event_time: bool = True,
) -> DataFrame:
    """The alert stream with ``emitted``, the cooldown decision, and state kept for every key.

    Needs a watermark on ``time`` in event time, and a session whose state store is ``ROCKSDB``.
    A retention below the cooldown would forget what a decision needs, so it is an error.
    """
    if retention < cooldown:
        raise ValueError(f"retention of {retention} s is below the cooldown of {cooldown} s")
    schema = _with_flag(alerts.schema)
    return alerts.groupBy(key).transformWithState(
        AlertState(time, cooldown, retention, event_time),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime" if event_time else "ProcessingTime",
    )


def read_alert_state(spark: SparkSession, checkpoint: str, key: str = "alert_key") -> DataFrame:
    """The state of all keys as the last complete micro-batch left it, read from the checkpoint."""
    stored = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE_VARIABLE).load()
    state = stored.select(F.col(f"key.{key}").alias(key), "value.*")
    return state.withColumns({c: F.timestamp_micros(c) for c in _TIMES})
