"""The harness: every business question's checks as rows of one result table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.audit import Relation, band_check, check, orphan_matrix, stack, violations
from wardflow.operators.reconcile import census_by_week, census_match_rate
from wardflow.plans import kpi_beds, kpi_claims, kpi_ed, kpi_pharmacy, kpi_readmissions, kpi_staffing
from wardflow.plans.star import LINKS
from wardflow.session import once

# Bands in which a figure is plausible.
OCCUPANCY_BAND = (0.55, 0.95)
READMISSION_BAND = (0.05, 0.30)
DENIAL_BAND = (0.08, 0.16)

RELATIONS = [
    Relation("bed_hourly", "unit_id", "unit", "unit_id"),
    Relation("admissions", "encounter_id", "encounters", "Id", 0.02),
    Relation("claim_header", "encounter_id", "encounters", "Id", 0.05),
    Relation("claim_header", "payer_id", "payer", "payer_id"),
    Relation("pharmacy_inventory", "facility_id", "facility", "facility_id"),
    Relation("encounters", "Patient", "patients", "Id"), Relation("admissions", "subject_id", "patients", "Id"),
    Relation("transfers", "hadm_id", "admissions", "hadm_id"), Relation("diagnoses", "hadm_id", "admissions", "hadm_id"),
    Relation("diagnoses", "encounter_id", "encounters", "Id"), Relation("ed_stays", "hadm_id", "admissions", "hadm_id"),
    Relation("ed_stays", "encounter_id", "encounters", "Id"),
    Relation("outpatient_visits", "encounter_id", "encounters", "Id"),
    Relation("outpatient_visits", "subject_id", "patients", "Id"),
    Relation("outpatient_visits", "unit_id", "unit", "unit_id"),
    Relation("outpatient_visits", "payer_id", "payer", "payer_id"),
    Relation("outpatient_visits", "primary_diagnosis_code", "icd10", "icd10_code"),
    Relation("outpatient_visits", "seen_by_provider_id", "staff", "staff_id"),
    Relation("admissions", "drg_code", "drg", "drg_code"), Relation("diagnoses", "icd_code", "icd10", "icd10_code"),
    Relation("claim_line", "patient_control_number", "claim_header", "patient_control_number"),
    Relation("remit", "patient_control_number", "claim_header", "patient_control_number"),
    Relation("remit_adjustment", "patient_control_number", "claim_header", "patient_control_number"),
    Relation("bed_nhsn", "nhsn_org_id", "facility", "facility_id"),
    Relation("pharmacy_inventory", "ndc11", "drug", "ndc11"), Relation("staff_schedules", "staff_id", "staff", "staff_id"),
    Relation("staff_schedules", "unit_code", "unit", "unit_code"),
]


#: Surrogate keys of each fact that should resolve (claim lines and adjustments hang on a claim number instead).
FACT_KEYS = {fact: [source.partition(":")[0] for source in links.values()] for fact, links in LINKS.items()}

#: Durations, counts and amounts that cannot be below zero.
MEASURES_FROM_ZERO = {
    "fact_encounters": ["base_encounter_cost", "total_claim_cost"], "fact_admissions": ["length_of_stay_hours"],
    "fact_ed_stays": ["wait_time_minutes", "length_of_stay_minutes"], "fact_outpatient_visits": ["wait_time_minutes"],
    "fact_transfers": ["transfer_duration_hours"], "fact_claims": ["total_charge_amount", "claim_payment_amount"],
    "fact_claim_lines": ["line_charge_amount"], "fact_claim_adjustments": ["amount"],
    "fact_bed_capacity": ["staffed_beds", "blocked_beds", "occupied_beds", "occupancy_rate"],
    "fact_pharmacy_inventory": ["qty_on_hand", "unit_cost"], "fact_staffing": ["scheduled_hours", "actual_hours"],
}


#: What the checks read of each Silver table.
CHECKED = {name: columns.split() for name, columns in {
    "ed_stays": "facility_id hadm_id disposition_folded intime_ts outtime_ts triage_time_ts provider_seen_time_ts "
                "admit_decision_time_ts acuity heartrate heartrate_int",
    "bed_hourly": "facility_id snapshot_datetime_ts staffed_beds_int blocked_beds_int occupied_beds_int occupancy_rate_float",
    "staff_schedules": "facility_id unit_code work_date_parsed shift staff_id job_code called_out census_int",
    "unit": "unit_code nurse_patient_ratio_target_float",
    "admissions": "encounter_id index_encounter_id hospital_expire_flag_bool discharge_location hospital_service dischtime_ts "
                  "is_readmission_bool is_planned_readmission_bool",
    "remit_adjustment": "group_code reason_code remark_code is_denial_bool",
    "pharmacy_inventory": "drug_name dea_schedule qty_on_hand_int reorder_point_int shortage_status days_on_hand_float",
    "claim_header": "patient_control_number total_charge_amount_float submission_date_d",
    "remit": "patient_control_number claim_status_code claim_payment_amount_float remit_date_d",
    "bed_nhsn": "nhsn_org_id collection_date_d all_hospital_inpatient_occupancy_int",
}.items()}


def referential_integrity(tables: Callable[[str], DataFrame], relations: list[Relation] | None = None) -> DataFrame:
    used = relations if relations is not None else RELATIONS
    names = {n for r in used for n in (r.child, r.parent)}
    return orphan_matrix(used, {n: tables(n) for n in names})


def census_reconciliation(beds: DataFrame, weekly: DataFrame) -> DataFrame:
    """The weekly report against the hourly feed, after rows without usable beds and impossible rows are set apart."""
    return census_by_week(kpi_beds.split_impossible(beds)[0], weekly)


def run_checks(tables: Callable[[str], DataFrame], columns: Callable[[str, Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """One row per check: name, PASS / WARN / FAIL, detail.  ``tables`` supplies Silver bases, ``columns`` some of their columns.

    Several checks look at each table, so the columns they need are computed once and written.
    """
    supplied = columns or (lambda name, wanted: tables(name).select(*wanted))
    tables = once(lambda name: supplied(name, CHECKED[name]))
    ed, beds, roster, units = tables("ed_stays"), tables("bed_hourly"), tables("staff_schedules"), tables("unit")
    admissions, adjustments, inventory = tables("admissions"), tables("remit_adjustment"), tables("pharmacy_inventory")
    claims = kpi_claims.claims_kpis(kpi_claims.with_remit(tables("claim_header"), tables("remit")))
    occupancy, readmission = kpi_beds.occupancy(beds), kpi_readmissions.hrrp(admissions)
    understaffed = kpi_staffing.understaffing(roster, units)
    ed_counts = kpi_ed.ed_summary(ed).agg(F.count_if(F.col("measure").isin("OP-18", "ED-1", "ED-2")).alias("n"))
    match = census_match_rate(census_reconciliation(beds, tables("bed_nhsn")))
    stock = kpi_pharmacy.stockout_risk(inventory)
    return stack([
        check(ed_counts, "ed_throughput_measures_present", F.col("n") == 3, F.col("n"), "FAIL"),
        check(ed.agg(F.count_distinct(F.to_date("intime_ts")).alias("n")), "wait_trend_has_points", F.col("n") > 1, F.col("n")),
        band_check(occupancy, "mean_occupancy_in_band", "mean_occupancy", *OCCUPANCY_BAND),
        check(occupancy, "some_units_at_capacity", F.col("share_at_capacity") > 0,
              F.round("share_at_capacity", 4)),
        check(kpi_beds.zero_bed_rows(beds), "bedless_rows_unrated", F.col("wrongly_rated") == 0,
              F.col("zero_bed_rows"), "FAIL"),
        check(match, "weekly_census_agrees", F.col("match_rate") >= 0.9,
              F.round("match_rate", 4)),
        check(understaffed, "some_shifts_below_target", F.col("share_understaffed") > 0,
              F.round("share_understaffed", 4)),
        check(kpi_staffing.understaffing_spread(roster, units), "understaffing_varies_by_department", F.col("spread") > 0.2,
              F.round("spread", 4)),
        check(readmission, "enough_index_stays", F.col("is_computable"), F.col("index_admissions")),
        band_check(readmission, "readmission_rate_in_band", "rate", *READMISSION_BAND),
        check(kpi_readmissions.rule_breaks(admissions), "index_stays_follow_rules", F.col("rule_breaks") == 0, F.col("rule_breaks"), "FAIL"),
        band_check(claims, "denial_rate_in_band", "denial_rate", *DENIAL_BAND),
        check(claims, "some_claims_paid", F.col("median_days_to_pay").isNotNull(),
              F.round("median_days_to_pay", 1), "FAIL"),
        check(adjustments.agg(F.count_if(kpi_claims.adjustment_class() == "write_off").alias("n")), "write_offs_told_from_denials",
              F.col("n") > 0, F.col("n")),
        violations(adjustments, "reason_16_has_remark", kpi_claims.missing_remark()),
        violations(adjustments, "reason_15_absent", kpi_claims.retired_reason()),
        check(stock, "some_stock_at_risk", F.col("share_at_risk") > 0, F.round("share_at_risk", 4)),
        check(inventory.agg(F.count("dea_schedule").alias("n")), "controlled_drugs_flagged", F.col("n") > 0, F.col("n")),
        violations(inventory, "sedatives_unscheduled", kpi_pharmacy.wrongly_scheduled()),
        check(ed.agg(F.count_if(kpi_ed.visible_defect()).alias("n")), "stay_defects_detectable", F.col("n") > 0, F.col("n")),
    ])
