"""30-day unplanned readmissions under the HRRP counting rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.aggregates import both_sides, ratio
from wardflow.operators.joins import attribute_to_index
from wardflow.operators.neighbours import neighbour
from wardflow.session import settle

FOLLOW_UP_DAYS = 30
MIN_INDEX = 30
# Stays that are no index admission.
AGAINST_ADVICE = "AGAINST ADVICE"
PSYCHIATRIC = "PSYCH"
HRRP_COLUMNS = ["encounter_id", "index_encounter_id", "dischtime_ts", "hospital_expire_flag_bool", "discharge_location",
                "hospital_service", "is_readmission_bool", "is_planned_readmission_bool"]


def eligible_index(admissions: DataFrame) -> DataFrame:
    """Discharged alive, not against advice, not psychiatric, and observed for 30 days after.

    The observation window ends at the last discharge of the whole extract; later index stays
    cannot have been followed up and are left out (right-censoring).
    """
    end = admissions.agg(F.max("dischtime_ts"))
    return (admissions.withColumn("_end", end.scalar())
            .filter(~F.col("hospital_expire_flag_bool")
                    & (F.coalesce("discharge_location", F.lit("")) != AGAINST_ADVICE)
                    & (F.coalesce("hospital_service", F.lit("")) != PSYCHIATRIC)
                    & (F.col("dischtime_ts") <= F.timestamp_add("DAY", F.lit(-FOLLOW_UP_DAYS), F.col("_end"))))
            .drop("_end"))


def unplanned(admissions: DataFrame) -> DataFrame:
    return admissions.filter(F.col("is_readmission_bool")
                             & ~F.coalesce("is_planned_readmission_bool", F.lit(False)))


def rule_breaks(admissions: DataFrame) -> DataFrame:
    """``rule_breaks``: index stays that died, left against advice, were psychiatric, or share their encounter with another index stay."""
    barred = (F.col("hospital_expire_flag_bool") | (F.col("discharge_location") == AGAINST_ADVICE) | (F.col("hospital_service") == PSYCHIATRIC))
    per_encounter = eligible_index(admissions).groupBy("encounter_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(barred).alias("barred"))
    repeats = F.when(F.col("encounter_id").isNotNull(), F.col("n") - 1).otherwise(0)
    return per_encounter.agg(F.coalesce(F.sum(F.col("barred") + repeats), F.lit(0)).alias("rule_breaks"))


def linked_readmissions(admissions: DataFrame) -> DataFrame:
    """Unplanned readmissions whose index stay is itself eligible: one population, not two."""
    index = eligible_index(admissions).select(F.col("encounter_id").alias("index_encounter_id")).distinct()
    return unplanned(admissions).join(index, "index_encounter_id", "left_semi")


def hrrp(admissions: DataFrame, min_index: int = MIN_INDEX) -> DataFrame:
    """The rate, or NULL ("not computable") on fewer than ``min_index`` index stays.

    Four figures come from the admissions, so the few columns they need are computed once and written.
    """
    admissions = settle(admissions.select(*HRRP_COLUMNS))
    base = admissions.agg(F.max("dischtime_ts").alias("window_end"))
    out = (base.withColumn("index_admissions", eligible_index(admissions).agg(F.count(F.lit(1))).scalar())
           .withColumn("unplanned_readmissions", unplanned(admissions).agg(F.count(F.lit(1))).scalar())
           .withColumn("linked_readmissions", linked_readmissions(admissions).agg(F.count(F.lit(1))).scalar()))
    enough = F.col("index_admissions") >= min_index
    return (out.withColumn("is_computable", enough)
            .withColumn("rate", F.when(enough, ratio(F.col("linked_readmissions"), F.col("index_admissions")))))


def hrrp_by(admissions: DataFrame, column: str, index: DataFrame | None = None) -> DataFrame:
    """Rate by an attribute of the *index* stay, for numerator and denominator alike."""
    stays = eligible_index(admissions) if index is None else index
    known = stays.filter(F.col(column).isNotNull())
    denominators = known.groupBy(column).agg(F.count(F.lit(1)).alias("index_admissions"))
    returns = attribute_to_index(unplanned(admissions), known, "index_encounter_id", "encounter_id", [column])
    numerators = returns.groupBy(column).agg(F.count(F.lit(1)).alias("readmissions"))
    return both_sides(denominators, numerators, [column]).withColumn(
        "rate", ratio(F.col("readmissions"), F.col("index_admissions")))


def hrrp_by_cohort(admissions: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """By cohort of the index stay's principal diagnosis."""
    principal = (diagnoses.filter("seq_num_int = 1 AND hadm_id IS NOT NULL")
                 .groupBy("hadm_id").agg(F.min("hrrp_cohort").alias("hrrp_cohort")))
    index = eligible_index(admissions).join(principal, "hadm_id", "left")
    return hrrp_by(admissions, "hrrp_cohort", index)


def returns_within(stays: DataFrame, person: str, start: str, end: str, key: str, days: int = FOLLOW_UP_DAYS,
                   ) -> DataFrame:
    """Derive returns from the stays themselves: the next stay of a person within ``days`` of the
    end of this one.  A person's stays are cut by month, so no person is one task."""
    linked = neighbour(stays.select(person, start, end, key), [person], [start, key],
                       {"next_start": start, "next_key": key}, F.date_trunc("month", start))
    gap = F.datediff("next_start", end)
    return linked.withColumn("gap_days", gap).filter(gap.between(0, days))
