"""Denials, payment delay and revenue at risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.aggregates import share_of, sum_where, top
from wardflow.operators.dedupe import latest_child

# Remittance status of a denial; write-off reasons that are no denials.
DENIED = "4"
WRITE_OFF_REASONS = ["45", "97", "24"]
DENIAL_GROUPS = ["CO", "OA"]


def with_remit(headers: DataFrame, remits: DataFrame) -> DataFrame:
    """Claims with their latest remittance; one row per claim."""
    last = latest_child(remits, "patient_control_number", "remit_date_d").select(
        "patient_control_number", "claim_status_code", F.col("claim_payment_amount_float").alias("paid"), "remit_date_d")
    return headers.join(last, "patient_control_number", "left").withColumns({
        "is_denied": F.col("claim_status_code") == DENIED,
        "days_to_payment": F.datediff("remit_date_d", "submission_date_d")})


def _measures() -> list[Column]:
    # days between two dates of the extract: a small domain, so the built-in median is exact and safe
    charge, denied = F.col("total_charge_amount_float"), F.col("is_denied")
    unpaid = charge - F.coalesce(F.col("paid"), F.lit(0).cast("decimal(18,2)"))
    return [F.count(F.lit(1)).alias("claims"), share_of(denied).alias("denial_rate"), F.sum(charge).alias("charges"),
            sum_where(denied, charge).alias("denied_charges"), sum_where(denied, unpaid).alias("revenue_at_risk"),
            F.median("days_to_payment").alias("median_days_to_pay")]


def claims_kpis(claims: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Denial rate over adjudicated claims, charges, denied charges, amount still unpaid on denied
    claims, and median days to payment."""
    adjudicated = claims.filter("claim_status_code IS NOT NULL")
    return adjudicated.groupBy(*by).agg(*_measures()) if by else adjudicated.agg(*_measures())


def denial_rate(claims: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return claims_kpis(claims, by).select(*by, "claims", "denial_rate")


def days_to_payment(claims: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return claims_kpis(claims, by).select(*by, "median_days_to_pay")


def revenue_at_risk(claims: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return claims_kpis(claims, by).select(*by, "claims", "denial_rate", "charges", "denied_charges", "revenue_at_risk")


def adjustment_class() -> Column:
    """A contractual write-off is not a denial."""
    group, reason = F.col("group_code"), F.col("reason_code")
    return (F.when(F.col("is_denial_bool") & group.isin(*DENIAL_GROUPS), "denial")
            .when((group == "CO") & reason.isin(*WRITE_OFF_REASONS), "write_off")
            .when(group == "PR", "patient_responsibility").otherwise("other"))


def denial_mix(adjustments: DataFrame) -> DataFrame:
    return (adjustments.withColumn("adjustment_class", adjustment_class()).groupBy("adjustment_class")
            .agg(F.count(F.lit(1)).alias("adjustments"), F.sum("amount_float").alias("amount")))


def top_denial_reasons(adjustments: DataFrame, k: int = 8) -> DataFrame:
    reasons = (adjustments.filter("is_denial_bool").groupBy("group_code", "reason_code")
               .agg(F.count(F.lit(1)).alias("denials")))
    return top(reasons, [F.col("denials").desc(), F.col("group_code"), F.col("reason_code")], k)


def missing_remark() -> Column:
    """Reason 16 requires a remark code."""
    return (F.col("reason_code") == "16") & F.col("is_denial_bool") & F.col("remark_code").isNull()


def retired_reason() -> Column:
    """Reason 15 was retired in 2018."""
    return F.col("reason_code") == "15"
