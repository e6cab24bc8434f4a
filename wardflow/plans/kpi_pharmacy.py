"""Stockout risk and stock derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.aggregates import count_where, share_of, top
from wardflow.operators.percentiles import medians_with

SHORTAGE = "Currently in Shortage"


def _at_risk() -> Column:
    return F.col("qty_on_hand_int") <= F.col("reorder_point_int")


def stockout_risk(inventory: DataFrame) -> DataFrame:
    """Share at or below reorder point, stockout rows, shortage share, median days on hand."""
    known = F.coalesce(_at_risk(), F.lit(False))
    return medians_with(
        inventory, [], "days_on_hand_float", {"median_days_on_hand": 0.5},
        F.count(F.lit(1)).alias("rows"), share_of(known).alias("share_at_risk"),
        count_where(F.col("qty_on_hand_int") <= 0).alias("stockouts"),
        share_of(F.coalesce(F.col("shortage_status") == SHORTAGE, F.lit(False))).alias("share_in_shortage"))


def frequent_risks(inventory: DataFrame, k: int = 10) -> DataFrame:
    """Items most often at or below their reorder point."""
    counts = (inventory.filter(_at_risk()).groupBy("facility_id", "drug_name")
              .agg(F.count(F.lit(1)).alias("days_at_risk")))
    return top(counts, [F.col("days_at_risk").desc(), F.col("facility_id"), F.col("drug_name")], k)


def days_on_hand(inventory: DataFrame) -> DataFrame:
    """Derived stock columns: cover in days, reorder trigger, value."""
    cover = F.round(F.try_divide("qty_on_hand_int", "avg_daily_usage_30d_float"), 2)
    return inventory.withColumns({
        "derived_days_on_hand": cover, "needs_reorder": _at_risk(),
        "derived_value": (F.col("qty_on_hand_int") * F.col("unit_cost_float")).cast("decimal(18,2)")})


def wrongly_scheduled() -> Column:
    """Propofol and dexmedetomidine are not scheduled drugs."""
    return F.col("drug_name").rlike("(?i)propofol|dexmedetomidine") & F.col("dea_schedule").isNotNull()
