"""Cooldown per alert key: send an alert only if the last one sent is old enough.

Each decision depends on the last *sent* alert, which no window frame expresses, so this
is the one operator with per-row Python.  It sees alerts, one per key and window, never
raw events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

COOLDOWN_SECONDS = 900


def _with_flag(schema, name: str = "emitted"):
    from pyspark.sql.types import BooleanType, StructField, StructType

    return StructType([*schema.fields, StructField(name, BooleanType())])


def _with_run(alerts: DataFrame, key: str, time: str, seconds: int) -> DataFrame:
    """Number the runs of each key that a quiet period separates.

    Time is cut into slots of the cooldown's length.  A send in one slot can only hold
    back the next slot, so a slot without any alert makes what follows independent.  The
    window runs over distinct (key, slot) pairs, not over alerts.
    """
    slot = F.floor(F.unix_seconds(time) / seconds).alias("__slot")
    slotted = alerts.select("*", slot)
    in_order = Window.partitionBy(key).orderBy("__slot")
    starts = F.coalesce(F.col("__slot") - F.lag("__slot").over(in_order) > 1, F.lit(True))
    runs = (
        slotted.select(key, "__slot")
        .distinct()
        .withColumn("__starts", starts)
        .withColumn("__run", F.count_if("__starts").over(in_order))
        .drop("__starts")
    )
    return slotted.join(runs, [key, "__slot"]).drop("__slot")


def cooldown_batch(
    alerts: DataFrame, key: str = "alert_key", time: str = "event_time", seconds: int = COOLDOWN_SECONDS
) -> DataFrame:
    """Mark which alerts are sent; every alert needs a key and a time.

    Give it windowed alerts (at most one per key and window): a key then has as many rows
    as windows, whatever the event volume.  Keys are further split at quiet periods.
    Spark partitions and sorts on disk; Python walks each partition batch by batch and
    keeps two values, so memory does not grow with a key.
    """
    schema = _with_flag(alerts.schema)
    names = schema.fieldNames()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, last_sent = None, None
        gap = pd.Timedelta(seconds=seconds)
        for pdf in batches:
            flags = []
            for k, run, t in zip(pdf[key], pdf["__run"], pdf[time]):
                if (k, run) != current:
                    current, last_sent = (k, run), None
                sent = last_sent is None or t >= last_sent + gap
                if sent:
                    last_sent = t
                flags.append(sent)
            yield pdf.assign(emitted=flags)[names]

    ordered = (
        _with_run(alerts, key, time, seconds)
        .repartition(key, "__run")
        .sortWithinPartitions(key, "__run", time)
    )
    return ordered.mapInPandas(walk, schema)


def cooldown_stream(
    alerts: DataFrame, key: str = "alert_key", time: str = "event_time", seconds: int = COOLDOWN_SECONDS
) -> DataFrame:
    """Streaming twin with the last sent time as state.

    Needs a watermark on ``time``; state goes once the watermark has passed the cooldown,
    when it can no longer suppress anything.
    """
    schema = _with_flag(alerts.schema)
    names = schema.fieldNames()

    def step(
        _key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last_sent = state.get[0] if state.exists else None
        # One key's alerts of one micro-batch: at most one per window.
        rows = pd.concat(list(batches)).sort_values(time, kind="stable")
        flags = []
        for t in rows[time]:
            micros = int(t.value // 1000)
            sent = last_sent is None or micros >= last_sent + seconds * 1_000_000
            if sent:
                last_sent = micros
            flags.append(sent)
        state.update((last_sent,))
        expires = last_sent // 1000 + seconds * 1000
        if expires > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(expires)
        else:  # it can suppress nothing any more
            state.remove()
        yield rows.assign(emitted=flags)[names]

    return alerts.groupBy(key).applyInPandasWithState(
        step,
        outputStructType=schema,
        stateStructType="last_sent long",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
