"""Emergency department and outpatient waits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.calendar import minutes_between
from wardflow.operators.aggregates import share_of
from wardflow.operators.joins import group_join
from wardflow.operators.percentiles import exact_percentiles

# Dispositions of patients who went home from the ED.
DISCHARGED = ["home", "left against medical advice"]

TO_TRIAGE = ("intime_ts", "triage_time_ts")
TO_DOCTOR = ("triage_time_ts", "provider_seen_time_ts")
TOTAL = ("intime_ts", "outtime_ts")
BOARDING = ("admit_decision_time_ts", "outtime_ts")


def _discharged() -> Column:
    return F.col("disposition_folded").isin(*DISCHARGED) & F.col("hadm_id").isNull()


def _tall(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """One row per (row, named value), so that several medians share one pass."""
    pairs = F.array(*[F.struct(F.lit(name).alias("measure"), value.cast("double").alias("minutes"))
                      for name, value in values.items()])
    return df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.measure", "_p.minutes")


def waits(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column],
          quantiles: Mapping[str, float]) -> DataFrame:
    """Exact quantiles and counts of several durations per group, in tall form."""
    tall = _tall(df, keys, values).filter("minutes IS NOT NULL")
    ranks = exact_percentiles(tall, [*keys, "measure"], "minutes", quantiles)
    counts = tall.groupBy(*keys, "measure").agg(F.count(F.lit(1)).alias("n"))
    return group_join(counts, ranks, [*keys, "measure"], "inner")


def ed_measures(ed: DataFrame) -> dict[str, Column]:
    """OP-18, ED-1, ED-2 and the door-to-… intervals as columns, NULL where not applicable."""
    total = minutes_between(*TOTAL)
    return {"OP-18": F.when(_discharged(), total), "ED-1": F.when(F.col("hadm_id").isNotNull(), total),
            "ED-2": minutes_between(*BOARDING), "door_to_triage": minutes_between(*TO_TRIAGE),
            "door_to_doctor": minutes_between(*TO_DOCTOR)}


def ed_summary(ed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median minutes per measure.  The three CMS measures are never blended."""
    return waits(ed, by, ed_measures(ed), {"median_minutes": 0.5})


def op18(ed: DataFrame) -> DataFrame:
    """Arrival to departure of patients discharged home and not admitted."""
    return ed_summary(ed.filter(_discharged())).filter("measure = 'OP-18'")


def ed1(ed: DataFrame) -> DataFrame:
    return ed_summary(ed.filter("hadm_id IS NOT NULL")).filter("measure = 'ED-1'")


def ed2(ed: DataFrame) -> DataFrame:
    return ed_summary(ed.filter("admit_decision_time_ts IS NOT NULL")).filter("measure = 'ED-2'")


def door_to(ed: DataFrame, milestone: str) -> DataFrame:
    """``milestone``: triage or doctor."""
    return ed_summary(ed).filter(F.col("measure") == f"door_to_{milestone}")


def ed_waits_by(ed: DataFrame, by: str = "facility_id") -> DataFrame:
    """Stays, median and 90th percentile of total minutes, median minutes to triage."""
    values = {"total": minutes_between(*TOTAL), "triage": minutes_between(*TO_TRIAGE)}
    tall = waits(ed, [by], values, {"median": 0.5, "p90": 0.9})
    pick = lambda name, column: F.max(F.when(F.col("measure") == name, F.col(column)))
    waiting = tall.groupBy(by).agg(
        pick("total", "median").alias("median_total"), pick("total", "p90").alias("p90_total"),
        pick("triage", "median").alias("median_triage"))
    stays = ed.groupBy(by).agg(F.count("stay_id").alias("stays"))
    return group_join(stays, waiting, [by]).orderBy(F.col("median_total").desc_nulls_last(), by)


def ed_trend(ed: DataFrame) -> DataFrame:
    """Median total minutes per arrival day."""
    daily = ed.select(F.to_date("intime_ts").alias("day"), minutes_between(*TOTAL).alias("minutes"))
    return exact_percentiles(daily, ["day"], "minutes", {"median_total": 0.5}).filter("day IS NOT NULL").orderBy("day")


def outpatient_waits(visits: DataFrame, by: str = "facility_id") -> DataFrame:
    """Patient wait (arrival to provider) and clinic delay (appointment to provider).

    Two different questions, kept apart.  No-shows have their own rate and are in neither wait;
    early arrival is legal.
    """
    kept = visits.filter(~F.coalesce("is_no_show_bool", F.lit(False)))
    values = {"wait": minutes_between("arrival_time_ts", "provider_seen_time_ts"),
              "delay": minutes_between("appointment_time_ts", "provider_seen_time_ts")}
    tall = waits(kept, [by], values, {"median": 0.5})
    pick = lambda name: F.max(F.when(F.col("measure") == name, F.col("median")))
    medians = tall.groupBy(by).agg(pick("wait").alias("median_patient_wait"),
                                   pick("delay").alias("median_appointment_delay"))
    counts = visits.groupBy(by).agg(F.count(F.lit(1)).alias("visits"),
                                    share_of(F.col("is_no_show_bool")).alias("no_show_rate"))
    return group_join(counts, medians, [by])


def visible_defect() -> Column:
    """Defects that a stay shows by itself: it ends before it begins, has no acuity, or a heart rate that is no number."""
    return (F.coalesce(F.col("outtime_ts") < F.col("intime_ts"), F.lit(False)) | F.col("acuity").isNull()
            | (F.col("heartrate").isNotNull() & F.col("heartrate_int").isNull()))
