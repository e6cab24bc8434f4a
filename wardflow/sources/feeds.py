"""The feed registry: one declaration per landed table.

Column lists are fixed values: the delivered header of each feed, in delivered order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardflow.operators.audit import Cadence

PROVENANCE = ["_ingested_at", "_source_file", "_batch_id"]


@dataclass(frozen=True)
class Feed:
    """``keys`` identify a row across batches; ``weekday`` is the ISO weekday of a weekly feed."""

    table: str
    folder: str
    columns: tuple[str, ...]
    keys: tuple[str, ...] = ()
    weekday: int | None = None
    workbook: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


def _feed(table: str, folder: str, columns: str, keys: str = "", **more) -> Feed:
    return Feed(table, folder, tuple(columns.split()), tuple(keys.split()), **more)


FEEDS = {f.table: f for f in [
    _feed("facility", "reference/dim_facility",
          "facility_id facility_name facility_type region city state zip county "
          "emergency_services licensed_beds staffed_beds ownership", "facility_id", weekday=1),
    _feed("unit", "reference/dim_unit",
          "unit_id facility_id unit_code unit_name unit_type building floor licensed_beds "
          "staffed_beds blocked_beds nurse_patient_ratio_target is_critical_care is_monitored",
          "unit_id", weekday=1),
    _feed("payer", "reference/dim_payer",
          "payer_id payer_name payer_type claim_filing_indicator_code share prompt_pay_days",
          "payer_id", weekday=1),
    _feed("drug", "reference/dim_drug",
          "rxcui_scd rxcui_in ndc11 product_ndc gtin14 proprietary_name non_proprietary_name "
          "dosage_form_name route_name pharm_classes dea_schedule dea_drug_code is_controlled "
          "labeler_name unit_cost usage_weight is_shortage_prone is_high_alert ndc_source abc_class",
          "ndc11", weekday=1),
    _feed("staff", "reference/dim_staff",
          "staff_id npi first_name last_name job_code job_title credential primary_facility_id "
          "primary_unit_id employment_type fte hire_date termination_date is_active", weekday=1),
    _feed("icd10", "reference/dim_icd10",
          "icd10_code icd10_description icd_version code_chapter diagnosis_category care_setting "
          "hrrp_cohort is_chronic readmission_risk_level relative_frequency", "icd10_code", weekday=1),
    _feed("drg", "reference/dim_drg",
          "drg_code drg_description relative_weight severity_tier drg_family drg_type weight_source",
          "drg_code", weekday=1),
    _feed("patients", "ehr/patients",
          "Id BirthDate DeathDate SSN Drivers Passport Prefix First Middle Last Suffix Maiden "
          "Marital Race Ethnicity Gender BirthPlace Address City State County FIPS_County_Code Zip "
          "Lat Lon Healthcare_Expenses Healthcare_Coverage Income phone email is_high_risk mrn "
          "source_facility_id", "Id"),
    _feed("encounters", "ehr/encounters",
          "Id Start Stop Patient Organization Provider Payer EncounterClass Code Description "
          "Base_Encounter_Cost Total_Claim_Cost Payer_Coverage ReasonCode ReasonDescription "
          "facility_id unit_id encounter_class_code encounter_status patient_class mrn "
          "source_system", "Id"),
    _feed("admissions", "ehr/admissions",
          "subject_id hadm_id admittime dischtime deathtime admission_type admit_provider_id "
          "admission_location discharge_location insurance language marital_status race edregtime "
          "edouttime hospital_expire_flag facility_id admission_type_code admit_decision_time "
          "hospital_service transferred_in_within_6h is_readmission is_planned_readmission "
          "index_encounter_id encounter_id drg_code source_system", "hadm_id"),
    _feed("ed_stays", "ehr/ed_stays",
          "subject_id stay_id encounter_id hadm_id intime outtime gender race arrival_transport "
          "disposition temperature heartrate resprate o2sat sbp dbp pain acuity chiefcomplaint "
          "triage_time provider_seen_time admit_decision_time facility_id source_system", "stay_id"),
    _feed("outpatient_visits", "ehr/outpatient_visits",
          "visit_id encounter_id subject_id facility_id unit_id clinic_type appointment_time "
          "arrival_time provider_seen_time departure_time seen_by_provider_id visit_status "
          "is_no_show escalated_to_inpatient primary_diagnosis_code payer_id mrn source_system",
          "visit_id"),
    _feed("transfers", "ehr/transfers",
          "subject_id hadm_id transfer_id eventtype careunit intime outtime facility_id unit_id",
          "transfer_id"),
    _feed("diagnoses", "ehr/diagnoses",
          "subject_id hadm_id encounter_id seq_num icd_code icd_version icd_title hrrp_cohort "
          "facility_id", "encounter_id seq_num"),
    _feed("claim_header", "claims/claim_header",
          "patient_control_number encounter_id hadm_id subject_id facility_id total_charge_amount "
          "claim_filing_indicator_code payer_id payer_name type_of_bill statement_date_from "
          "statement_date_to admission_date_and_hour discharge_time admission_type_code "
          "admission_source_code patient_status_code drg_code principal_diagnosis "
          "admitting_diagnosis other_diagnoses attending_provider_npi medical_record_number "
          "prior_authorization_number is_readmission_related submission_date",
          "patient_control_number"),
    _feed("claim_line", "claims/claim_line",
          "patient_control_number line_control_number revenue_code revenue_code_description "
          "procedure_code procedure_code_qualifier procedure_description line_charge_amount "
          "unit_type unit_count non_covered_amount service_date_from service_date_to",
          "patient_control_number line_control_number"),
    _feed("remit", "claims/remit",
          "patient_control_number payer_id claim_status_code claim_status_description "
          "total_claim_charge_amount claim_payment_amount patient_responsibility_amount "
          "payer_claim_control_number drg_code drg_weight check_eft_trace_number "
          "payment_method_code check_date remit_date is_appealed is_overturned_on_appeal"),
    _feed("remit_adjustment", "claims/remit_adjustment",
          "patient_control_number adjustment_seq group_code group_code_description reason_code "
          "reason_code_description amount quantity remark_code remark_code_description is_denial",
          "patient_control_number adjustment_seq"),
    _feed("bed_hourly", "beds/hourly_snapshot",
          "snapshot_datetime facility_id unit_id unit_code licensed_beds staffed_beds blocked_beds "
          "occupied_beds available_beds pending_admissions pending_discharges occupancy_rate "
          "is_at_capacity", "facility_id unit_id snapshot_datetime"),
    _feed("bed_nhsn", "beds/nhsn_weekly",
          "nhsn_org_id facility_name week_ending_date collection_date all_hospital_inpatient_beds "
          "all_hospital_inpatient_occupancy all_adult_inpatient_beds all_adult_inpatient_occupancy "
          "all_pediatric_inpatient_beds all_pediatric_inpatient_occupancy all_icu_beds "
          "all_icu_bed_occupancy adult_icu_beds adult_icu_bed_occupancy pediatric_icu_beds "
          "pediatric_icu_bed_occupancy", weekday=7),
    _feed("pharmacy_inventory", "pharmacy/inventory",
          "snapshot_date counting_datetime count_type facility_id location_id ndc11 product_ndc "
          "gtin14 rxcui_scd drug_name dosage_form_name route_name pharm_classes lot_number "
          "expiration_date qty_on_hand base_unit qty_on_order par_level reorder_point safety_stock "
          "avg_daily_usage_30d days_on_hand abc_class is_controlled dea_schedule is_high_alert "
          "shortage_status shortage_reason unit_cost extended_value last_count_variance "
          "last_restocked_at is_stockout", "facility_id ndc11 location_id counting_datetime"),
    _feed("staff_schedules", "sharepoint/staff_schedules",
          "facility_id unit unit_code work_date shift shift_start shift_end staff_id name job_code "
          "employment_type scheduled_hours actual_hours status overtime called_out floated_in "
          "census notes", weekday=1, workbook=True),
]}


def cadences() -> list[Cadence]:
    """When each registered feed is due."""
    return [Cadence(f.table, f.weekday) for f in FEEDS.values()]


def conform(df: DataFrame, feed: Feed) -> DataFrame:
    """All declared columns as strings in declared order (absent ones NULL), plus provenance."""
    have = set(df.columns)
    out = [f"CAST({f'`{c}`' if c in have else 'NULL'} AS STRING) AS `{c}`" for c in feed.columns]
    return df.selectExpr(*out, *[c for c in PROVENANCE if c in have])
