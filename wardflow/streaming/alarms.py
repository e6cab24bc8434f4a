"""Alarms for monitors that went silent.

Live: the state of an encounter is its last settled reading and what lies beyond the watermark; an event-time timer raises the alarm
while the monitor is still silent, and a discharge ends the watch. Nothing is kept of an encounter once its alarm is out or it
is discharged. In batch, ``silences`` gives the same intervals.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wardflow.operators.neighbours import neighbour

ALARM = "encounter_id string, silent_since timestamp, alarm_at timestamp"


def silence_alarms(events: DataFrame, max_gap_seconds: int = 300) -> DataFrame:
    """Stream: one row per silence of more than ``max_gap_seconds``, as soon as the watermark proves it.

    ``events`` are ``encounter_id, event_time, ends`` with a watermark on ``event_time``; ``ends`` marks discharges. Readings may come in
    any order within the watermark's delay: they take effect in order of event time, so the result does not depend on how
    events fall into micro-batches. Rows without encounter or time are left out.
    """
    gap = max_gap_seconds * 1000

    def watch(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, ahead = state.get if state.exists else (-1, "[]")
        ahead, settled_to, alarms = json.loads(ahead), state.getCurrentWatermarkMs(), []
        for frame in frames:
            times = frame["event_time"].astype("datetime64[ms]").astype("int64")
            ahead += [[int(t), bool(e)] for t, e in zip(times, frame["ends"], strict=True)]
        ahead.sort()
        while ahead and ahead[0][0] <= settled_to:
            at, ends = ahead.pop(0)
            if last >= 0 and at - last > gap:
                alarms.append(last)
            last = -1 if ends else max(at, last)
        if last >= 0 and settled_to > last + gap:
            alarms.append(last)
            last = -1
        if last < 0 and not ahead:
            state.remove()
        else:
            state.update((last, json.dumps(ahead)))
            timers = ([ahead[0][0]] if ahead else []) + ([last + gap + 1] if last >= 0 else [])
            state.setTimeoutTimestamp(max(min(timers), settled_to + 1))
        if alarms:
            since = pd.to_datetime(pd.Series(alarms), unit="ms")
            yield pd.DataFrame({"encounter_id": key[0], "silent_since": since, "alarm_at": since + pd.Timedelta(seconds=max_gap_seconds)})

    known = events.filter("encounter_id IS NOT NULL AND event_time IS NOT NULL").select(
        F.col("encounter_id").cast("string"), "event_time", F.coalesce("ends", F.lit(False)).alias("ends"))
    return known.groupBy("encounter_id").applyInPandasWithState(
        watch, ALARM, "last long, ahead string", "append", GroupStateTimeout.EventTimeTimeout)


def silences(events: DataFrame, until, max_gap_seconds: int = 300) -> DataFrame:
    """Batch: the alarms of ``events`` up to the time ``until``. Encounters are cut by day, so a long one is not one task."""
    rows = events.filter("encounter_id IS NOT NULL AND event_time IS NOT NULL").select(
        F.col("encounter_id").cast("string"), "event_time", F.coalesce("ends", F.lit(False)).alias("ends")).distinct()
    linked = neighbour(rows, ["encounter_id"], ["event_time", "ends"], {"_next": "event_time"}, F.to_date("event_time"))
    due = F.col("event_time") + F.make_dt_interval(secs=F.lit(max_gap_seconds))
    return (linked.filter(~F.col("ends") & (F.coalesce("_next", F.lit(until).cast("timestamp")) > due))
            .select("encounter_id", F.col("event_time").alias("silent_since"), due.alias("alarm_at")))
