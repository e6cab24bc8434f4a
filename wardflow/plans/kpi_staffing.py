"""Rostered nurses against the mandated patients-per-nurse targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.aggregates import count_where, share_of, spread, top

# Job codes that count as nurses, and the on-call shift, which is cover.
NURSES = ["RN", "LPN", "NP"]
ON_CALL = "OC"
SHIFT = ["facility_id", "unit_code", "work_date_parsed", "shift"]


def shift_staffing(roster: DataFrame, units: DataFrame) -> DataFrame:
    """One row per department shift: nurses on duty, census, required nurses.

    ``required`` is the census over the target rounded up, at least one; where census or target is
    unknown the shift is not called understaffed.
    """
    on_duty = roster.filter(F.col("job_code").isin(*NURSES) & (F.col("shift") != ON_CALL)
                            & (F.coalesce("called_out", F.lit("")) != "Y"))
    shifts = on_duty.groupBy(*SHIFT).agg(F.count("staff_id").alias("nurses_on"), F.max("census_int").alias("census"))
    targets = units.groupBy("unit_code").agg(F.max("nurse_patient_ratio_target_float").alias("target_ratio"))
    needed = F.greatest(F.lit(1), F.ceil(F.try_divide("census", "target_ratio")))
    known = F.col("census").isNotNull() & (F.col("target_ratio") > 0)
    return (shifts.join(targets, "unit_code", "left")
            .withColumn("required", F.when(known, needed).cast("int"))
            .withColumn("actual_ratio", F.try_divide("census", "nurses_on"))
            .withColumn("is_understaffed", F.coalesce(F.col("nurses_on") < F.col("required"), F.lit(False))))


def understaffing(roster: DataFrame, units: DataFrame) -> DataFrame:
    """Share of understaffed department shifts, and on-call shifts apart."""
    on_call = roster.filter(F.col("job_code").isin(*NURSES) & (F.col("shift") == ON_CALL))
    return (shift_staffing(roster, units)
            .agg(F.count(F.lit(1)).alias("shifts"), share_of(F.col("is_understaffed")).alias("share_understaffed"))
            .withColumn("on_call_shifts", on_call.agg(F.count(F.lit(1))).scalar()))


def by_department(roster: DataFrame, units: DataFrame) -> DataFrame:
    return shift_staffing(roster, units).groupBy("facility_id", "unit_code", "shift").agg(
        F.count(F.lit(1)).alias("shifts"), share_of(F.col("is_understaffed")).alias("pct_understaffed"),
        F.avg("actual_ratio").alias("mean_actual_ratio"), F.max("target_ratio").alias("target"))


def chronically_understaffed(roster: DataFrame, units: DataFrame, k: int = 10) -> DataFrame:
    return top(by_department(roster, units),
               [F.col("pct_understaffed").desc(), F.col("facility_id"), F.col("unit_code"), F.col("shift")], k)


def understaffing_spread(roster: DataFrame, units: DataFrame) -> DataFrame:
    """Spread over all department/shift combinations (never over a worst-of list)."""
    return spread(by_department(roster, units), "pct_understaffed")


def coverage(roster: DataFrame) -> DataFrame:
    return roster.groupBy("facility_id").agg(
        F.sum("scheduled_hours_float").alias("scheduled_hours"), F.sum("actual_hours_float").alias("actual_hours"),
        F.try_divide(F.sum("actual_hours_float"), F.sum("scheduled_hours_float")).alias("coverage"),
        count_where(F.col("called_out") == "Y").alias("called_out"))
