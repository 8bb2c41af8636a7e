"""Alert stream: parsing, windows, lateness, cooldown, restart."""

import datetime as dt
import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.sources.messages import read_message_files
from tidemark.streaming import alerts as al
from tidemark.streaming.cooldown import cooldown_batch, cooldown_stream
from tidemark.streaming.job import detect, read_alerts

T0 = 1_700_000_040_000  # a full minute
NOW = "2024-01-01 00:00:00"


def message(ts=T0, op="c", table="clinic_bookings", schema="public", after={"id": 1}, before=None, wrap=True):
    body = {"op": op, "ts_ms": ts, "before": before, "after": after}
    if table:
        body["source"] = {"schema": schema, "table": table}
    return json.dumps({"payload": body} if wrap else body)


CASES = [
    (message(), True),
    (message(wrap=False), True),
    (message(op="C"), True),
    (message(table="CLINIC_BOOKINGS"), True),
    (message(table=None), True),  # no source: the default table
    (message(after=None, before={"id": 1}), True),
    (message(op="u"), False),
    (message(op="x"), False),
    (message(table="users"), False),
    (message(after={}), False),
    (message(after="text"), False),
    ("{broken", False),
    ("[1]", False),
    ('"text"', False),
    ("", False),
]


@pytest.mark.parametrize("text,kept", CASES)
def test_event_filter(spark, text, kept):
    df = spark.createDataFrame([(text,)], "value string")
    assert al.parse_messages(df, now=F.lit(NOW)).count() == int(kept)


def test_event_time(spark):
    df = spark.createDataFrame([(message(ts=1000),), (message(ts=None),), (message(ts=0),)], "value string")
    got = rows(al.parse_messages(df, now=F.lit(NOW)).select(F.col("event_time").cast("string")))
    assert got == [("1970-01-01 00:00:01",), (NOW,), (NOW,)]


def test_spike_levels(spark):
    w = dt.datetime(2024, 1, 1)
    counts = spark.createDataFrame([(w, w, n) for n in (4, 5, 9, 10)],
                                   "window_start timestamp, window_end timestamp, total_events long")
    got = rows(al.spike_alerts(counts, threshold=5).select("total_events", "severity"))
    assert got == [(10, "critical"), (5, "warning"), (9, "warning")]


def run_once(df, path, fmt):
    q = (df.writeStream.format(fmt).outputMode("append").option("path", path)
         .option("checkpointLocation", f"{path}-cp").trigger(availableNow=True).start())
    q.awaitTermination()


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def test_stream_equals_batch_and_late_events_drop(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "alerts")
    minute = 60_000
    put(inbox, "a.txt", *[message(T0 + i * 1000) for i in range(3)], *[message(T0 + minute)] * 2)
    stream = lambda: detect(read_message_files(spark, str(inbox)), threshold=2)
    run_once(stream(), out, "text")
    # The watermark stands at the second minute: its window is open, the first one closed.
    put(inbox, "b.txt", message(T0 + 10 * minute))
    run_once(stream(), out, "text")
    # Late for the first minute: dropped, its alert keeps the old count.
    put(inbox, "c.txt", message(T0 + 500), message(T0 + 20 * minute))
    run_once(stream(), out, "text")
    got = read_alerts(spark.read.text(out)).select(F.unix_millis("window_start"), "total_events")
    assert rows(got) == [(T0, 3), (T0 + minute, 2)]
    batch = al.count_windows(al.parse_messages(spark.read.text(str(inbox / "a.txt"))))
    assert rows(batch.select(F.unix_millis("window_start"), "total_events")) == rows(got)


ALERT = "alert_key string, event_time timestamp"


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def greedy(times, cooldown):
    out, last = [], None
    for t in sorted(times):
        sent = last is None or t >= last + cooldown
        last = t if sent else last
        out.append((t, sent))
    return out


def sent(df):
    return [(r.alert_key, int((r.event_time - at(0)).total_seconds())) for r in
            df.filter("emitted").orderBy("alert_key", "event_time").collect()]


def test_cooldown_edges(spark):
    gaps = [0, 100, 899, 900, 901, 1800]
    df = spark.createDataFrame([("k", at(g)) for g in gaps], ALERT)
    assert sent(cooldown_batch(df)) == [("k", 0), ("k", 900), ("k", 1800)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cooldown_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    data = []
    for key in ("hot", "b", "c"):
        size = 600 if key == "hot" else 40
        # Quiet periods as well as bursts, with equal times.
        t = 0
        for _ in range(size):
            t += rnd.choice([0, 30, 400, 899, 900, 901, 5000])
            data.append((key, t))
    df = spark.createDataFrame([(k, at(t)) for k, t in data], ALERT)
    got = [tuple(x) for x in rows(cooldown_batch(df).select("alert_key", F.unix_seconds("event_time"), "emitted"))]
    base = int((at(0) - dt.datetime(1970, 1, 1)).total_seconds())
    want = []
    for key in {k for k, _ in data}:
        # Of equal times only the first is sent, as the second falls into the cooldown.
        want += [(key, base + t, s) for t, s in greedy([t for k, t in data if k == key], 900)]
    assert got == sorted(want, key=repr)


def test_cooldown_stream_keeps_state_over_restarts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    times = [0, 100, 899, 900, 901, 1800, 9000]
    for i, t in enumerate(times):
        one = spark.createDataFrame([("k", at(t)), ("other", at(t))], ALERT)
        one.coalesce(1).write.mode("append").parquet(src)
        if i in (1, 4, 6):  # three separate runs of the query
            raw = spark.readStream.schema(ALERT).parquet(src)
            run_once(cooldown_stream(raw.withWatermark("event_time", "1 hour")), out, "parquet")
    got = spark.read.parquet(out)
    want = [0, 900, 1800, 9000]
    assert sent(got) == [("k", t) for t in want] + [("other", t) for t in want]
    assert got.count() == 2 * len(times)


def test_history_rows(spark):
    df = spark.createDataFrame([(None, at(0), "s", True)], "alert_key string, event_time timestamp, severity string, emitted boolean")
    df = df.withColumn("alert_type", F.lit("t")).withColumn("source_table", F.lit(None).cast("string"))
    r = al.history_rows(al.with_alert_key(df), F.lit(NOW)).first()
    assert (r.alert_key, r.source_table, r.emitted) == ("t|unknown", "unknown", True)
    assert json.loads(r.payload_json)["alert_key"] == "t|unknown" and len(r.alert_id) == 40


def test_alert_state_takes_rows():
    """Plain rows go through the state of a key with one read, one write and its own timer."""
    from pyspark.sql import Row

    from tidemark.streaming.alert_state import AlertState

    class Handle:
        value, calls = None, []

        def getValueState(self, *_):
            return self

        def get(self):
            self.calls.append("get")
            return self.value

        def update(self, value):
            self.calls.append("update")
            self.value = value

        def registerTimer(self, at):
            self.calls.append(("timer", at))

        def deleteTimer(self, at):
            self.calls.append(("no timer", at))

    def alert(second, n):
        return Row(alert_key="a", event_time=dt.datetime(2024, 1, 1, 0, 0, second, tzinfo=dt.timezone.utc), total_events=n)

    handle, state = Handle(), AlertState("event_time", cooldown=10, retention=100, event_time=True)
    state.init(handle)
    out = list(state.handleInputRows(("a",), iter([alert(12, 3), alert(0, None), alert(9, 2)]), None))
    assert [(r.event_time.second, r.emitted) for r in out] == [(0, True), (9, False), (12, True)]
    base = 1_704_067_200
    assert handle.value[3:] == (
        (base + 12) * 10**6, (base + 12) * 10**6, '{"alert_key":"a","event_time":"2024-01-01T00:00:12","total_events":3}', 3, 1
    )
    assert [r.emitted for r in state.handleInputRows(("a",), iter([alert(5, 1)]), None)] == [False]  # late: no news
    assert handle.value[5].endswith('"total_events":3}') and handle.value[6:] == (4, 2)
    list(state.handleInputRows(("a",), iter([alert(30, 1)]), None))
    assert handle.calls == [
        "get", "update", ("timer", (base + 112) * 1000), "get", "update",
        "get", "update", ("no timer", (base + 112) * 1000), ("timer", (base + 130) * 1000),
    ]
    late = [r.emitted for r in state.handleInputRows(("a",), iter([Row(alert_key="a", event_time=None, total_events=1), alert(50, 1)]), None)]
    assert late == [True, False]  # one without a time comes last and is held back
