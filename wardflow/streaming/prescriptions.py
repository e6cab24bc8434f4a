"""Prescription events: typing, latencies, controlled drugs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.calendar import minutes_between
from wardflow.functions.parsing import to_double, to_int


def type_prescriptions(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "dose_val": to_double("dose_val_rx"), "form_val": to_double("form_val_disp"),
        "fill_qty": to_int("fill_quantity"),
        "verify_minutes": minutes_between("entertime", "verifiedtime"),
        "start_minutes": minutes_between("verifiedtime", "starttime"),
    })


def controlled_counts(typed: DataFrame) -> DataFrame:
    """Prescriptions and controlled ones per facility, with mean order-to-verify minutes."""
    return typed.groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("prescriptions"), F.count_if("is_controlled").alias("controlled"),
        F.avg("verify_minutes").alias("avg_verify_minutes"))
