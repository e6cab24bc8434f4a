"""Real streams over files, compared with the batch result of the same transform."""

import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F

from wardflow.sources.archive import read_archive, stream_archive
from wardflow.streaming import events as ev
from wardflow.streaming import sinks, vitals

START = dt.datetime(2026, 8, 5, 10)


def event(i, minutes, code, value, encounter="E1", lag=2, **more):
    at = START + dt.timedelta(minutes=minutes)
    payload = {"encounter_id": encounter, "unit_id": "U1", "charttime": at.isoformat(), "loinc_code": code, "value_num": value, "is_artifact": False, **more}
    return {"event_id": f"id{i}", "event_type": "vitals.reading", "event_time": at.isoformat(), "ingest_time": (at + dt.timedelta(seconds=lag)).isoformat(),
            "source_system": "MONITOR", "facility_id": "030301", "schema_version": "1.0", "payload": payload}


CODES = {"8867-4": 135, "8480-6": 85, "9279-1": 26, "8310-5": 37.0, "2708-6": 90}


def feed():
    out, i = [], 0
    for minutes in range(0, 60, 5):
        for code, value in CODES.items():
            if minutes < 30 or code != "2708-6":
                out.append(event(i, minutes, code, value if minutes < 30 else 75))
                i += 1
    out.append(out[3])                                              # repeated delivery
    out.append(event(900, 10, "8867-4", 10, is_artifact=True))      # artefact
    out.append(event(901, 12, "8867-4", None))                      # no value
    out.append({**event(902, 12, "8867-4", 1), "event_type": "prescription.issued"})
    out.append(event(903, 600, "8867-4", 80))                       # closes all earlier windows
    return out


def write(folder, events, name="patient-vitals.jsonl.gz"):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as out:
        out.write("\n".join(json.dumps(e) for e in events))


def readings(df):
    parsed = ev.parse_events(ev.route(df, ev.VITALS), ev.VITALS_PAYLOAD)
    return vitals.drop_artifacts(ev.dedupe_events(ev.with_event_watermark(parsed)))


def run(stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return stream.sparkSession.table(name)


def closed(df, column):
    """Windows before the watermark can still move."""
    return df.filter(F.col(column) < F.lit(START + dt.timedelta(hours=2)))


def test_news2_stream_equals_batch(spark, tmp_path, rows):
    write(tmp_path / "in", feed())
    pick = ("charttime", "encounter_id", "news2_score", "response", "parameters")
    batch = vitals.news2(vitals.pivot_vitals(readings(read_archive(spark, str(tmp_path / "in")))))
    live = run(vitals.news2(vitals.pivot_vitals(readings(stream_archive(spark, str(tmp_path / "in"))))), "news2")
    want = rows(closed(batch, "charttime"), *pick)
    assert rows(closed(live, "charttime"), *pick) == want and len(want) == 12
    assert want[0][2:] == (12, "emergency", 5) and want[-1][4] == 4


def test_window_median_and_dedupe_stream(spark, tmp_path, rows):
    write(tmp_path / "in", feed())
    pick = ("window_start", "loinc_code", "value_median", "readings")
    batch = vitals.window_median(readings(read_archive(spark, str(tmp_path / "in"))))
    live = run(vitals.window_median(readings(stream_archive(spark, str(tmp_path / "in")))), "medians")
    want = rows(closed(batch, "window_start"), *pick)
    assert rows(closed(live, "window_start"), *pick) == want
    assert all(r[3] == 1 for r in want), "the repeated event counts once"


def test_sessions_find_the_silence(spark, tmp_path, rows):
    write(tmp_path / "in", [event(i, m, "8867-4", 80) for i, m in enumerate([0, 4, 8, 30, 34, 600])])
    live = run(vitals.signal_sessions(readings(stream_archive(spark, str(tmp_path / "in")))), "spells")
    assert [r[1] for r in rows(live, "spell_start", "readings")] == [3, 2]
    gaps = vitals.signal_gaps(readings(read_archive(spark, str(tmp_path / "in"))))
    assert [r[0] for r in rows(gaps, "gap_seconds")] == [1320, 33960]


def test_malformed_payload_is_kept_and_marked(spark):
    df = spark.createDataFrame([("{bad", "1.0"), ('{"value_num": 5}', "1.0"), ('{"value_num": 5}', "9.9")], "payload string, schema_version string")
    assert [r["is_malformed"] for r in ev.parse_events(df, ev.VITALS_PAYLOAD).collect()] == [True, False, True]


def test_late_events_go_to_the_side_table(spark, tmp_path):
    write(tmp_path / "in", [event(0, 0, "8867-4", 80), event(1, 1, "8867-4", 81, lag=900)])
    late = ev.classify_late(stream_archive(spark, str(tmp_path / "in")))
    query = sinks.split_late(str(tmp_path / "ck"), sinks.batch_folder(str(tmp_path / "main")), sinks.batch_folder(str(tmp_path / "late")), late, available_now=True)
    query.awaitTermination(120)
    assert [r["event_id"] for r in spark.read.parquet(str(tmp_path / "main")).collect()] == ["id0"]
    assert [r["event_id"] for r in spark.read.parquet(str(tmp_path / "late")).collect()] == ["id1"]


def test_archive_restarts_where_it_stopped(spark, tmp_path):
    write(tmp_path / "in", [event(0, 0, "8867-4", 80)])
    for name in ("b.jsonl.gz", None):
        sinks.archive(stream_archive(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination(120)
        if name:
            write(tmp_path / "in", [event(1, 5, "8867-4", 80)], name)
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["id0", "id1"]


def test_in_flight_is_no_orphan(spark, rows):
    stream = spark.createDataFrame([("E1",), ("E2",)], "encounter_id string")
    known = spark.createDataFrame([("E1", "F1")], "encounter_id string, facility string")
    assert rows(ev.enrich_static(stream, known, ["facility"])) == [("E1", "F1", "closed"), ("E2", None, "in_flight")]


def test_silence_alarms_are_live_and_equal_batch(spark, tmp_path, rows):
    """Micro-batches with readings out of order: one alarm per silence, none after discharge, no state left."""
    from wardflow.streaming.alarms import silence_alarms, silences
    minute = lambda m: (START + dt.timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%S")
    batches = [[("A", 0, 0), ("A", 3, 0), ("B", 1, 0), ("C", 2, 0)],
               [("A", 12, 0), ("A", 11, 0), ("B", 3, 1), ("C", 4, 0), (None, 5, 0)],
               [("A", 8, 0), ("C", 30, 0), ("C", 31, 1), ("D", 31, 0)],
               [("A", 33, 0), ("A", 34, 1), ("B", 60, 0), ("B", 61, 1), ("D", 60, 1), ("Z", 90, 1)]]
    (tmp_path / "in").mkdir()
    for number, batch in enumerate(batches):
        path = tmp_path / "in" / f"{number}.json"
        path.write_text("\n".join(json.dumps({"encounter_id": e, "event_time": minute(m), "ends": bool(x)}) for e, m, x in batch))
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    schema = "encounter_id string, event_time timestamp, ends boolean"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")).withWatermark("event_time", "5 minutes")
    query = (silence_alarms(stream).writeStream.format("memory").queryName("silence").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination(180)
    live = rows(spark.table("silence"), "encounter_id", "silent_since", "alarm_at")
    known = spark.read.schema(schema).json(str(tmp_path / "in"))
    assert live == rows(silences(known, minute(85)), "encounter_id", "silent_since", "alarm_at")
    assert [(r[0], int((r[1] - START).total_seconds() // 60)) for r in live] == [("A", 12), ("C", 4), ("D", 31)]
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert left <= 1  # at most the last discharge, which the watermark has not passed
