"""Vital signs: medians per window, wide rows, NEWS2, alarms, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.clinical import (NEWS2_BANDS, NEWS2_EMERGENCY, NEWS2_URGENT, VITALS, is_alarm,
                                         news2_points)
from wardflow.operators.aggregates import latest_value_pivot
from wardflow.operators.neighbours import neighbour


def drop_artifacts(readings: DataFrame) -> DataFrame:
    """Readings without a value or marked as artefacts carry no information about the patient."""
    return readings.filter(F.col("value_num").isNotNull() & ~F.coalesce("is_artifact", F.lit(False)))


def with_alarm(readings: DataFrame) -> DataFrame:
    return readings.withColumn("is_alarm", is_alarm("loinc_code", "value_num"))


def window_median(readings: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Median reading per encounter, parameter and tumbling window.

    A window holds a handful of readings per encounter and parameter, which bounds the state.
    """
    return (readings.groupBy(F.window("event_time", width).alias("window"), "encounter_id", "loinc_code")
            .agg(F.median("value_num").alias("value_median"), F.count(F.lit(1)).alias("readings"))
            .select(F.col("window.start").alias("window_start"), "encounter_id", "loinc_code",
                    "value_median", "readings"))


def pivot_vitals(readings: DataFrame, width: str = "5 minutes") -> DataFrame:
    """One wide row per encounter and window; the latest ingested value wins per parameter.

    In append mode a row is emitted when the watermark closes its window, with whatever
    parameters have arrived: monitors drop out, and waiting for all six would lose the row.
    """
    keyed = readings.withColumn("_w", F.window("event_time", width))
    wide = latest_value_pivot(keyed, ["_w", "encounter_id"], "loinc_code", "value_num", "ingest_time", VITALS)
    return wide.select(F.col("_w.start").alias("charttime"), "encounter_id", *VITALS.values())


def news2(wide: DataFrame) -> DataFrame:
    """Aggregate score of the parameters present, with the response it calls for.

    ``parameters`` says how many of the five scored parameters contributed.
    """
    points = {f"{p}_score": news2_points(p) for p in NEWS2_BANDS}
    scored = wide.withColumns(points)
    present = sum(F.col(c).isNotNull().cast("int") for c in points)
    total = sum(F.coalesce(F.col(c), F.lit(0)) for c in points)
    worst = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in points])
    scored = scored.withColumns({"parameters": present, "news2_score": total, "worst_parameter": worst})
    response = (F.when(F.col("news2_score") >= NEWS2_EMERGENCY, "emergency")
                .when(F.col("news2_score") >= NEWS2_URGENT, "urgent")
                .when(F.col("worst_parameter") == 3, "review").otherwise("routine"))
    return scored.withColumn("response", response).drop(*points, "worst_parameter")


def alert_rate(readings: DataFrame, width: str = "1 hour") -> DataFrame:
    """Alarms and readings per unit and tumbling window."""
    return (with_alarm(readings).groupBy(F.window("event_time", width).alias("_w"), "unit_id")
            .agg(F.count(F.lit(1)).alias("readings"), F.count_if("is_alarm").alias("alarms"))
            .select(F.col("_w.start").alias("window_start"), "unit_id", "readings", "alarms",
                    F.try_divide("alarms", "readings").alias("alarm_rate")))


def signal_gaps(readings: DataFrame, max_gap_seconds: int = 300) -> DataFrame:
    """Batch: silences of an encounter's monitor longer than ``max_gap_seconds``.

    The group is cut by day, so one encounter with a third of the readings is not one task.
    """
    times = readings.select("encounter_id", "charttime").distinct()
    linked = neighbour(times, ["encounter_id"], ["charttime"], {"next_charttime": "charttime"},
                       F.to_date("charttime"))
    gap = F.unix_timestamp("next_charttime") - F.unix_timestamp("charttime")
    return linked.withColumn("gap_seconds", gap).filter(F.col("gap_seconds") > max_gap_seconds)


def signal_sessions(readings: DataFrame, max_gap: str = "5 minutes") -> DataFrame:
    """Stream: unbroken spells of signal; the silence lies between two spells."""
    return (readings.groupBy(F.session_window("event_time", max_gap).alias("_s"), "encounter_id")
            .agg(F.count(F.lit(1)).alias("readings"))
            .select("encounter_id", F.col("_s.start").alias("spell_start"),
                    F.col("_s.end").alias("spell_end"), "readings"))
