"""Bed occupancy, pressure, and bed snapshots derived from stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.aggregates import count_where, share_of, top
from wardflow.operators.intervals import (counts_over_time, deltas, levels, presence, running_counts, total_counts,
                                          within_next)
from wardflow.operators.quality import quarantine
from wardflow.session import settle

AT_CAPACITY = 0.85
LOOK_AHEAD_HOURS = 4


def with_occupancy(beds: DataFrame) -> DataFrame:
    """Occupied share of the beds that are staffed and not blocked; NULL without such beds."""
    usable = F.col("staffed_beds_int") - F.col("blocked_beds_int")
    return beds.withColumn("usable_beds", usable).withColumn(
        "occ", F.when(usable > 0, F.try_divide("occupied_beds_int", "usable_beds")))


def split_impossible(beds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) among rows with usable beds: over-full or negative is a data error."""
    rated = with_occupancy(beds).filter("usable_beds > 0")
    return quarantine(rated, (F.col("occ") > 1) | (F.col("occupied_beds_int") < 0) | (F.col("staffed_beds_int") <= 0))


def occupancy(beds: DataFrame, threshold: float = AT_CAPACITY) -> DataFrame:
    """Mean occupancy and share of unit-hours at the threshold, after quarantine."""
    rated = with_occupancy(beds).filter("usable_beds > 0")
    bad = F.coalesce((F.col("occ") > 1) | (F.col("occupied_beds_int") < 0) | (F.col("staffed_beds_int") <= 0),
                     F.lit(False))
    occ = F.when(~bad, F.col("occ"))
    return rated.agg(
        F.count(F.lit(1)).alias("rows"), count_where(bad).alias("quarantined"),
        F.avg(occ).alias("mean_occupancy"),
        F.avg(F.when(~bad, F.coalesce(F.col("occ") >= threshold, F.lit(False)).cast("double"))).alias("share_at_capacity"))


def pressure(beds: DataFrame, k: int = 12, threshold: float = AT_CAPACITY) -> DataFrame:
    """Top ``k`` units by mean occupancy."""
    clean, _ = split_impossible(beds)
    by_unit = clean.groupBy("facility_id", "unit_code").agg(
        F.avg("occ").alias("mean_occ"), F.max("occ").alias("peak_occ"),
        count_where(F.col("occ") >= threshold).alias("hours_at_capacity"))
    return top(by_unit, [F.col("mean_occ").desc(), F.col("facility_id"), F.col("unit_code")], k)


def zero_bed_rows(beds: DataFrame) -> DataFrame:
    """Rows without usable beds, and those of them that wrongly carry an occupancy."""
    none = (F.col("staffed_beds_int") - F.col("blocked_beds_int") <= 0) & (F.col("staffed_beds_int") >= 0)
    return beds.agg(count_where(none).alias("zero_bed_rows"),
                    count_where(none & F.col("occupancy_rate_float").isNotNull()).alias("wrongly_rated"))


def _bed_changes(stays: DataFrame) -> tuple[DataFrame, list[str]]:
    spans = {"occupied_beds": presence("intime_ts", "outtime_ts", "hour"),
             "pending_discharges": within_next("outtime_ts", LOOK_AHEAD_HOURS, "hour")}
    return deltas(stays, ["unit_id"], spans, "snapshot_datetime"), list(spans)


def _available(usable: Column) -> Column:
    return F.greatest(F.lit(0), usable - F.col("occupied_beds"))


def _at_capacity(usable: Column) -> Column:
    return F.when(usable > 0, F.col("occupied_beds") / usable >= AT_CAPACITY)


def bed_snapshots(stays: DataFrame, units: DataFrame, boarding: DataFrame | None = None) -> DataFrame:
    """Hourly unit snapshots from stays (unit_id, intime_ts, outtime_ts).

    ``boarding`` (facility_id, start_ts, end_ts) gives pending admissions per facility; stays that
    end within the next four hours are the pending discharges.
    """
    changes, spans = _bed_changes(stays)
    hourly = running_counts(changes, ["unit_id"], spans, "hour", "snapshot_datetime")
    if boarding is None:
        waiting = None
    else:
        waiting = counts_over_time(boarding, ["facility_id"],
                                   {"pending_admissions": presence("start_ts", "end_ts", "hour")},
                                   "hour", "snapshot_datetime")
    beds = units.select("unit_id", "facility_id", "unit_code", "licensed_beds", "staffed_beds", "blocked_beds")
    out = hourly.join(beds, "unit_id")
    if waiting is not None:
        out = out.join(waiting, ["facility_id", "snapshot_datetime"], "left")
    else:
        out = out.withColumn("pending_admissions", F.lit(0).cast("long"))
    usable = F.col("staffed_beds") - F.col("blocked_beds")
    rate = F.when(usable > 0, F.round(F.col("occupied_beds") / usable, 4))
    return out.select(
        "snapshot_datetime", "facility_id", "unit_id", "unit_code", "licensed_beds", "staffed_beds", "blocked_beds",
        "occupied_beds", _available(usable).alias("available_beds"),
        F.coalesce("pending_admissions", F.lit(0)).alias("pending_admissions"), "pending_discharges",
        rate.alias("occupancy_rate"),
        _at_capacity(usable).alias("is_at_capacity"))


def bed_totals(stays: DataFrame, units: DataFrame) -> DataFrame:
    """``bed_snapshots`` summed per hour over all units, from the hours in which a unit changes; no unit is expanded into hours."""
    changes, spans = _bed_changes(stays)
    changes = settle(changes)  # read for the last hour and the levels
    held = levels(changes, ["unit_id"], spans, "snapshot_datetime").join(
        units.select("unit_id", "staffed_beds", "blocked_beds"), "unit_id")
    usable = F.col("staffed_beds") - F.col("blocked_beds")
    values = {"units": F.lit(1), "occupied_beds": F.col("occupied_beds"), "pending_discharges": F.col("pending_discharges"),
              "available_beds": _available(usable), "units_at_capacity": _at_capacity(usable)}
    last = changes.agg(F.max("snapshot_datetime").alias("_last"))
    return total_counts(held, ["unit_id"], values, "hour", last, "snapshot_datetime")


def midnight_census(stays: DataFrame) -> DataFrame:
    """Patients per unit at 00:00 of each day."""
    return counts_over_time(stays, ["unit_id"], {"census": presence("intime_ts", "outtime_ts", "day")}, "day", "day")


def weekly_capacity(hourly: DataFrame, pediatric: Column, intensive: Column) -> DataFrame:
    """Weekly facility report as of the week's Wednesday, from 24 hourly rows per unit.

    ``pediatric`` and ``intensive`` tell which rows count for those columns; the week ends on
    Sunday.  Sums over the day are divided by 24, dropping the fraction.
    """
    day = F.to_date("snapshot_datetime_ts")
    cells = {"all_hospital_inpatient": F.lit(True), "all_adult_inpatient": ~pediatric,
             "all_pediatric_inpatient": pediatric, "all_icu": intensive,
             "adult_icu": intensive & ~pediatric, "pediatric_icu": intensive & pediatric}
    aggregates = []
    for name, test in cells.items():
        tail = "_bed_occupancy" if name.endswith("icu") else "_occupancy"
        for column, suffix in (("staffed_beds_int", "_beds"), ("occupied_beds_int", tail)):
            total = F.sum(F.when(test, F.col(column)).otherwise(0))
            aggregates.append(F.floor(total / 24).alias(name + suffix))
    return (hourly.filter(F.dayofweek("snapshot_datetime_ts") == 4)
            .groupBy("facility_id", day.alias("collection_date")).agg(*aggregates)
            .withColumn("week_ending_date", F.date_add("collection_date", 4)))


def share_at_capacity(beds: DataFrame) -> DataFrame:
    """The feed's own flag, per facility."""
    return beds.groupBy("facility_id").agg(share_of(F.col("is_at_capacity_bool")).alias("share_at_capacity"))
