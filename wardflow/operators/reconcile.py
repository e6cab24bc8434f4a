"""The hourly bed feed against the weekly capacity report, in both forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.calendar import iso_year
from wardflow.functions.parsing import to_int
from wardflow.operators.dedupe import latest_per_key
from wardflow.operators.quality import gate


def staffed_beds_by_week(hourly: DataFrame, facilities: DataFrame, weekly: DataFrame,
                         tolerance: float = 0.05) -> DataFrame:
    """Staffed beds at Wednesday's last hour against the reported beds of the same ISO week.

    The variance is kept whatever it is; above ``tolerance`` of the reported figure it is a
    MISMATCH.  Weeks are numbered with their own year, so the turn of the year joins correctly.
    """
    at_hour = (gate(hourly).withColumn("snapshot_date", F.to_date("snapshot_datetime_ts"))
               .filter(F.dayofweek("snapshot_date") == 4)
               .groupBy("facility_id", "snapshot_date", "snapshot_datetime_ts")
               .agg(F.sum(to_int("staffed_beds")).alias("hourly_total_staffed_beds")))
    last_hour = latest_per_key(at_hour, ["facility_id", "snapshot_date"],
                               ["snapshot_datetime_ts DESC"])
    detail = last_hour.select(
        "facility_id", "snapshot_date", "hourly_total_staffed_beds",
        F.weekofyear("snapshot_date").alias("iso_week"), iso_year("snapshot_date").alias("iso_year"))
    report = gate(weekly).select(
        "facility_name", "week_ending_date_d", "all_hospital_inpatient_beds_int",
        F.weekofyear("week_ending_date_d").alias("iso_week"), iso_year("week_ending_date_d").alias("iso_year"))
    names = facilities.select("facility_id", "facility_name")
    compared = (detail.join(names, "facility_id")
                .join(report, ["facility_name", "iso_week", "iso_year"]))
    # The names of the result's columns.
    variance = F.abs(F.col("hourly_total_staffed_beds") - F.col("all_hospital_inpatient_beds_int"))
    return (compared.select("facility_id", "facility_name", "snapshot_date", "week_ending_date_d",
                            "hourly_total_staffed_beds", "all_hospital_inpatient_beds_int",
                            variance.alias("variance"))
            .withColumn("variance_pct", F.try_divide("variance", "all_hospital_inpatient_beds_int"))
            .withColumn("reconciliation_flag",
                        F.when(F.col("variance_pct") > tolerance, "MISMATCH").otherwise("OK")))


def census_by_week(hourly: DataFrame, weekly: DataFrame) -> DataFrame:
    """Mean occupied beds of the collection day against the reported occupancy, per facility-week.

    Within max(2 beds, 5 %) of the hourly figure is a match.
    """
    per_day = (hourly.groupBy("facility_id", F.to_date("snapshot_datetime_ts").alias("collection_date_d"))
               .agg((F.sum("occupied_beds_int") / 24).alias("hourly_census")))
    report = weekly.select(
        F.col("nhsn_org_id").alias("facility_id"), F.col("collection_date_d"),
        F.col("all_hospital_inpatient_occupancy_int").alias("reported_census"))
    gap = F.abs(F.col("hourly_census") - F.col("reported_census"))
    return (report.join(per_day, ["facility_id", "collection_date_d"])
            .withColumn("gap", gap)
            .withColumn("within_tolerance", gap <= F.greatest(F.lit(2.0), F.col("hourly_census") * 0.05)))


def census_match_rate(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count(F.lit(1)).alias("facility_weeks"),
                        F.avg(F.col("within_tolerance").cast("double")).alias("match_rate"))
