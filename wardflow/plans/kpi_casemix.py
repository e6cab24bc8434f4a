"""Diagnosis families, severity and case-mix index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.clinical import (DEFAULT_FAMILY, DRG_FAMILY_PREFIXES, chronic, readmission_risk,
                                         severity_tier)
from wardflow.operators.joins import longest_prefix


def with_family(df: DataFrame, code: str = "icd_code", name: str = "drg_family") -> DataFrame:
    return longest_prefix(df, code, DRG_FAMILY_PREFIXES, name, DEFAULT_FAMILY)


def label_icd(codes: DataFrame) -> DataFrame:
    """Family, chronic flag and readmission risk of a code set (icd10_code, hrrp_cohort)."""
    return with_family(codes, "icd10_code", "diagnosis_category").withColumns({
        "is_chronic": chronic("icd10_code"), "readmission_risk_level": readmission_risk("icd10_code", "hrrp_cohort")})


def drg_assignments(stays: DataFrame, diagnoses: DataFrame, drgs: DataFrame) -> DataFrame:
    """Relative weight per stay from principal diagnosis family and severity tier.

    ``stays``: hadm_id, facility_id, los_days, is_icu, is_expired.  A family without the wanted
    tier uses the nearest: CC falls back to MCC, then to the family's last code.
    """
    principal = (diagnoses.filter("seq_num_int = 1 AND hadm_id IS NOT NULL")
                 .groupBy("hadm_id").agg(F.min("icd_code").alias("icd_code")))
    tier = lambda name: F.max_by("relative_weight", F.when(F.col("severity_tier") == name, F.col("drg_code")))
    weights = drgs.groupBy("drg_family").agg(
        tier("MCC").alias("mcc"), tier("CC").alias("cc"), tier("NONE").alias("none"),
        F.max_by("relative_weight", "drg_code").alias("last"))
    rated = with_family(stays.join(principal, "hadm_id")).withColumn(
        "severity_tier", severity_tier(F.col("is_icu"), F.col("los_days"), F.col("is_expired")))
    weight = (F.when((F.col("severity_tier") == "MCC") & F.col("mcc").isNotNull(), F.col("mcc"))
              .when(F.col("severity_tier") != "NONE", F.coalesce("cc", "mcc", "last"))
              .otherwise(F.coalesce("none", "last")))
    return rated.join(weights, "drg_family", "left").withColumn("relative_weight", weight).drop("mcc", "cc", "none", "last")


def case_mix(stays: DataFrame, diagnoses: DataFrame, drgs: DataFrame) -> DataFrame:
    """Case-mix index (mean relative weight) per facility."""
    return drg_assignments(stays, diagnoses, drgs).groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("stays"), F.avg("relative_weight").alias("case_mix_index"))
