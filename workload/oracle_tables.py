"""Expected results in DuckDB SQL: the common table expressions of Bronze, Silver and Gold."""

from __future__ import annotations

import re

from wardflow.sources.feeds import FEEDS
from workload.derive import DuckDb, event_feed, feeds

AS_OF = "2024-06-30"


def typed(kind: str, raw: str) -> str:
    return {
        "int": f"try_cast(trunc(try_cast({raw} as double)) as integer)",
        "double": f"try_cast({raw} as double)", "money": f"try_cast({raw} as decimal(18,2))",
        "bool": f"try_cast({raw} as boolean)", "day": f"try_cast({raw} as date)",
        "clinical": f"""coalesce(case source_system when 'ACADEMIC_CIS' then try_strptime({raw}, '%Y-%m-%dT%H:%M:%S')
            when 'REGIONAL_HIS' then try_strptime({raw}, '%d/%m/%Y %H:%M') when 'COMMUNITY_CARE_EHR' then try_strptime({raw}, '%m/%d/%Y %H:%M') end,
            try_cast({raw} as timestamp))""",
        "time": f"try_cast({raw} as timestamp)", "fold": f"lower(trim({raw}))",
    }[kind]


def shown(kind: str, column: str) -> str:
    """How a column of a given kind is printed in a registered query."""
    q = f'"{column}"'
    return {
        "clinical": f"strftime({q}, '%Y-%m-%d %H:%M:%S') as {q}", "time": f"strftime({q}, '%Y-%m-%d %H:%M:%S') as {q}", "day": f"strftime({q}, '%Y-%m-%d') as {q}",
        "money": f"cast({q} as double) as {q}", "rate": f"round({q}, 9) as {q}",
    }.get(kind, q)


BRONZE = feeds(DuckDb())


def _picked(name: str, keys: list[str], source: str) -> str:
    """First row per key: newest batch, then all other columns descending."""
    present = set(re.findall(r'as "?(\w+)"?', BRONZE[name]))
    rest = [c for c in FEEDS[name].columns if c in present and c not in keys]
    order = ", ".join(f'"{c}" desc nulls last' for c in rest)
    by = ", ".join(f'"{k}"' for k in keys)
    lead = "_batch_id desc nulls last, " if name not in ("bed_hourly", "pharmacy_inventory") else ""
    tail = ", _batch_id desc nulls last"
    return f"select * from {source} qualify row_number() over (partition by {by} order by {lead}{order}{tail}) = 1"


def orphan(column: str, parent: str, key: str) -> str:
    return f"{column} is not null and {column} not in (select {key} from {parent} where {key} is not null)"


FACILITY = (orphan("facility_id", "picked_facility", "facility_id"), "facility_id not found in silver_facility")
UNIT = (orphan("unit_id", "picked_unit", "unit_id"), "unit_id not found in silver_unit")
CLAIM = (orphan("patient_control_number", "passed_claims", "patient_control_number"),
         "patient_control_number not found in silver_claim_header")


def unread(*columns: str) -> list[tuple[str, str]]:
    return [(f'"{c}" is not null and "{c}_ts" is null', f"{c} unparseable") for c in columns]


def person(column: str) -> tuple[str, str]:
    return ("canonical_patient_key is null", f"{column} not found in silver_patients")


def null(column: str, message: str | None = None) -> tuple[str, str]:
    return f"{column} is null", message or f"{column} null"


# name -> (typed columns, rules, patient column)
SILVER: dict[str, tuple[dict[str, tuple[str, str]], list[tuple[str, str]], str | None]] = {
    "facility": ({"facility_type_folded": ("fold", "facility_type"), "emergency_services_bool": ("bool", "emergency_services"),
                  "licensed_beds_int": ("int", "licensed_beds"), "staffed_beds_int": ("int", "staffed_beds")},
                 [null("facility_id"),
                  ("facility_type_folded not in ('general acute care','teaching','regional','community','urgent care')", "invalid facility_type"),
                  ("licensed_beds_int is null or licensed_beds_int < 0 or (licensed_beds_int = 0 and facility_type_folded <> 'urgent care')",
                   "invalid licensed_beds")], None),
    "unit": ({"unit_type_folded": ("fold", "unit_type"), "licensed_beds_int": ("int", "licensed_beds"),
              "staffed_beds_int": ("int", "staffed_beds"), "blocked_beds_int": ("int", "blocked_beds"),
              "nurse_patient_ratio_target_float": ("double", "nurse_patient_ratio_target"),
              "is_critical_care_bool": ("bool", "is_critical_care"), "is_monitored_bool": ("bool", "is_monitored")},
             [null("unit_id"), null("facility_id"), ("licensed_beds_int is null or licensed_beds_int < 0", "invalid licensed_beds"),
              ("staffed_beds_int > licensed_beds_int", "staffed_beds exceeds licensed_beds"), FACILITY], None),
    "payer": ({"payer_type_folded": ("fold", "payer_type"), "share_float": ("double", "share"), "prompt_pay_days_int": ("int", "prompt_pay_days")},
              [null("payer_id"), ("share_float < 0 or share_float > 1", "share out of 0-1 range")], None),
    "drug": ({"is_controlled_bool": ("bool", "is_controlled"), "is_shortage_prone_bool": ("bool", "is_shortage_prone"),
              "is_high_alert_bool": ("bool", "is_high_alert"), "unit_cost_float": ("money", "unit_cost"), "usage_weight_float": ("double", "usage_weight")},
             [null("ndc11"), ("unit_cost_float is null or unit_cost_float < 0", "invalid unit_cost")], None),
    "staff": ({"fte_float": ("double", "fte"), "is_active_bool": ("bool", "is_active")},
              [null("staff_id"), ("fte_float <= 0 or fte_float > 1", "fte out of range")], None),
    "icd10": ({"icd_version_int": ("int", "icd_version"), "is_chronic_bool": ("bool", "is_chronic"), "relative_frequency_float": ("double", "relative_frequency")},
              [null("icd10_code"), ("icd_version_int not in (9, 10)", "invalid icd_version")], None),
    "drg": ({"relative_weight_float": ("double", "relative_weight")},
            [null("drg_code"), ("severity_tier not in ('MCC','CC','NONE')", "invalid severity_tier"),
             ("relative_weight_float is null or relative_weight_float < 0", "invalid relative_weight")], None),
    "patients": ({"BirthDate_date": ("day", '"BirthDate"'), "Healthcare_Expenses_float": ("money", '"Healthcare_Expenses"'),
                  "Healthcare_Coverage_float": ("money", '"Healthcare_Coverage"'), "is_high_risk_bool": ("bool", "is_high_risk")},
                 [null('"Id"', "Id null"), null('"BirthDate_date"', "BirthDate unparseable")], None),
    "encounters": ({"Start_ts": ("clinical", '"Start"'), "Stop_ts": ("clinical", '"Stop"'), "Base_Encounter_Cost_float": ("money", '"Base_Encounter_Cost"'),
                    "Total_Claim_Cost_float": ("money", '"Total_Claim_Cost"')},
                   [null('"Id"', "encounter Id null"), ('"Stop_ts" < "Start_ts"', "Stop before Start"), FACILITY, UNIT, person("Patient"),
                    *unread("Start", "Stop")], '"Patient"'),
    "admissions": ({"admittime_ts": ("clinical", "admittime"), "dischtime_ts": ("clinical", "dischtime"), "is_readmission_bool": ("bool", "is_readmission"),
                    "is_planned_readmission_bool": ("bool", "is_planned_readmission"), "hospital_expire_flag_bool": ("bool", "hospital_expire_flag")},
                   [null("hadm_id"), ("dischtime_ts < admittime_ts", "dischtime before admittime"), FACILITY, person("subject_id"),
                    *unread("admittime", "dischtime")], "subject_id"),
    "ed_stays": ({"intime_ts": ("clinical", "intime"), "outtime_ts": ("clinical", "outtime"), "triage_time_ts": ("clinical", "triage_time"),
                  "provider_seen_time_ts": ("clinical", "provider_seen_time"), "admit_decision_time_ts": ("clinical", "admit_decision_time"),
                  "disposition_folded": ("fold", "disposition"), "acuity_int": ("int", "acuity"), "heartrate_int": ("int", "heartrate")},
                 [null("stay_id"), ("acuity_int < 1 or acuity_int > 5", "acuity out of 1-5 range"), FACILITY,
                  ("triage_time_ts < intime_ts", "triage_time before intime"),
                  (orphan("hadm_id", "picked_admissions", "hadm_id"), "hadm_id not found in silver_admissions"), person("subject_id"),
                  *unread("intime", "outtime", "triage_time", "provider_seen_time", "admit_decision_time")], "subject_id"),
    "outpatient_visits": ({"appointment_time_ts": ("clinical", "appointment_time"), "arrival_time_ts": ("clinical", "arrival_time"),
                           "provider_seen_time_ts": ("clinical", "provider_seen_time"), "departure_time_ts": ("clinical", "departure_time"),
                           "visit_status_folded": ("fold", "visit_status"), "is_no_show_bool": ("bool", "is_no_show"),
                           "escalated_to_inpatient_bool": ("bool", "escalated_to_inpatient")},
                          [null("visit_id"), ("visit_status_folded not in ('completed','no show','admitted')", "invalid visit_status"), FACILITY, UNIT,
                           (orphan("encounter_id", "picked_encounters", '"Id"'), "encounter_id not found in silver_encounters"),
                           (orphan("payer_id", "picked_payer", "payer_id"), "payer_id not found in silver_payer"),
                           (orphan("primary_diagnosis_code", "picked_icd10", "icd10_code"), "primary_diagnosis_code not found in silver_icd10"),
                           (orphan("seen_by_provider_id", "bronze_staff", "staff_id"), "seen_by_provider_id not found in silver_staff"),
                           person("subject_id"),
                           *unread("appointment_time", "arrival_time", "provider_seen_time", "departure_time")], "subject_id"),
    "transfers": ({"intime_ts": ("time", "intime"), "outtime_ts": ("time", "outtime")},
                  [null("transfer_id"), FACILITY, UNIT, ("outtime_ts < intime_ts", "outtime before intime"), person("subject_id")], "subject_id"),
    "diagnoses": ({"seq_num_int": ("int", "seq_num"), "icd_version_int": ("int", "icd_version")},
                  [null("icd_code"), ("icd_version_int not in (9, 10)", "invalid icd_version"), FACILITY, person("subject_id")], "subject_id"),
    "claim_header": ({"total_charge_amount_float": ("money", "total_charge_amount"), "submission_date_d": ("day", "submission_date"),
                      "is_readmission_related_bool": ("bool", "is_readmission_related")},
                     [null("patient_control_number"), ("total_charge_amount_float is null or total_charge_amount_float < 0", "invalid total_charge_amount"),
                      FACILITY, ("payer_id is null or payer_id not in (select payer_id from picked_payer)", "payer_id not found in silver_payer"),
                      ("total_charge_amount_float > 500000", "total_charge_amount implausibly large for a single claim"),
                      (orphan("attending_provider_npi", "bronze_staff", "npi"), "attending_provider_npi not found in silver_staff"),
                      person("subject_id")], "subject_id"),
    "claim_line": ({"line_charge_amount_float": ("money", "line_charge_amount"), "unit_count_int": ("int", "unit_count")},
                   [null("patient_control_number"), CLAIM], None),
    "remit": ({"claim_payment_amount_float": ("money", "claim_payment_amount"), "total_claim_charge_amount_float": ("money", "total_claim_charge_amount"),
               "remit_date_d": ("day", "remit_date"), "is_appealed_bool": ("bool", "is_appealed"), "is_overturned_on_appeal_bool": ("bool", "is_overturned_on_appeal")},
              [null("patient_control_number"), CLAIM, ("claim_payment_amount_float > total_claim_charge_amount_float * 5",
               "claim_payment_amount implausibly larger than total_claim_charge_amount")], None),
    "remit_adjustment": ({"amount_float": ("money", "amount"), "is_denial_bool": ("bool", "is_denial")}, [null("patient_control_number"), CLAIM], None),
    "bed_hourly": ({"snapshot_datetime_ts": ("time", "snapshot_datetime"), "staffed_beds_int": ("int", "staffed_beds"), "blocked_beds_int": ("int", "blocked_beds"),
                    "occupied_beds_int": ("int", "occupied_beds"), "available_beds_int": ("int", "available_beds"),
                    "occupancy_rate_float": ("double", "occupancy_rate"), "is_at_capacity_bool": ("bool", "is_at_capacity")},
                   [null("snapshot_datetime_ts", "snapshot_datetime unparseable"),
                    ("occupancy_rate_float < 0 or occupancy_rate_float > 1", "occupancy_rate out of 0-1 range"), FACILITY, UNIT], None),
    "bed_nhsn": ({"week_ending_date_d": ("day", "week_ending_date"), "collection_date_d": ("day", "collection_date"),
                  "all_hospital_inpatient_beds_int": ("int", "all_hospital_inpatient_beds"),
                  "all_hospital_inpatient_occupancy_int": ("int", "all_hospital_inpatient_occupancy")},
                 [null("week_ending_date_d", "week_ending_date unparseable"),
                  ("all_hospital_inpatient_occupancy_int > all_hospital_inpatient_beds_int", "occupancy exceeds bed count"),
                  (orphan("facility_name", "picked_facility", "facility_name"), "facility_name not found in silver_facility")], None),
    "pharmacy_inventory": ({"snapshot_date_d": ("day", "snapshot_date"), "qty_on_hand_int": ("int", "qty_on_hand"), "reorder_point_int": ("int", "reorder_point"),
                            "days_on_hand_float": ("double", "days_on_hand"), "avg_daily_usage_30d_float": ("double", "avg_daily_usage_30d"),
                            "unit_cost_float": ("money", "unit_cost"), "is_stockout_bool": ("bool", "is_stockout"), "is_controlled_bool": ("bool", "is_controlled")},
                           [null("ndc11"), ("qty_on_hand_int is null or qty_on_hand_int < 0", "invalid qty_on_hand"), FACILITY], None),
    "staff_schedules": ({"scheduled_hours_float": ("double", "scheduled_hours"), "actual_hours_float": ("double", "actual_hours"), "census_int": ("int", "census")},
                        [null("staff_id"), null("facility_id"), null("work_date_parsed", "work_date unparseable"), FACILITY,
                         (orphan("staff_id", "bronze_staff", "staff_id"), "staff_id not found in silver_staff")], None),
}

SHOW_KEYS = {
    "staff": ["staff_id", "valid_from", "valid_to", "is_current"], "remit": ["patient_control_number", "remit_date", "claim_status_code"],
    "bed_nhsn": ["nhsn_org_id", "facility_name"], "facility": ["facility_id", "staffed_exceeds_licensed_info"],
    "patients": ["Id", "mpi_key", "canonical_patient_key"],
    "staff_schedules": ["facility_id", "staff_id", "shift_start"],
}


def silver_columns(name: str) -> list[tuple[str, str]]:
    """(column, kind) printed by the Silver queries."""
    out = [(c, "text") for c in SHOW_KEYS.get(name, FEEDS[name].keys)]
    out += [(c, kind) for c, (kind, _) in SILVER[name][0].items()]
    if SILVER[name][2]:
        out.append(("canonical_patient_key", "text"))
    if name == "staff_schedules":
        out.append(("work_date_parsed", "day"))
    return out + [("_dq_issues", "text"), ("_dq_passed", "text")]


CTES: dict[str, str] = {}
for _name, _sql in BRONZE.items():
    CTES[f"bronze_{_name}"] = _sql
CTES["events_feed"] = event_feed(DuckDb())
CTES["passed_claims"] = "select patient_control_number from silver_claim_header where _dq_passed"
for _name, (_types, _rules, _patient) in SILVER.items():
    if _name == "staff_schedules":
        _source = ("(select *, coalesce(cast(try_strptime(work_date, '%Y-%m-%d') as date), cast(try_strptime(work_date, '%m/%d/%Y') as date)) "
                   "as work_date_parsed from bronze_staff_schedules)")
        CTES["picked_staff_schedules"] = _picked(_name, ["facility_id", "staff_id", "work_date_parsed", "shift_start"], _source)
    elif FEEDS[_name].keys:
        CTES[f"picked_{_name}"] = _picked(_name, list(FEEDS[_name].keys), f"bronze_{_name}")
    else:
        CTES[f"picked_{_name}"] = f"select * from bronze_{_name}"
    _more = {"staff": ", _batch_id as valid_from, lead(_batch_id) over (partition by staff_id order by _batch_id) as valid_to",
             "patients": """, case when trim("SSN") <> '' then 'ssn:' || "SSN" else
                concat_ws('|', 'demo', "BirthDate", lower("Last"), lower("First"), "Zip") end as mpi_key"""}.get(_name, "")
    _types_sql = ", ".join(f'{typed(k, r)} as "{c}"' for c, (k, r) in _types.items())
    _inner = f"select p.*, {_types_sql}{_more} from picked_{_name} p"
    if _name == "staff":
        _inner = f"select *, valid_to is null as is_current from ({_inner})"
    if _name == "facility":
        _inner = f"select *, staffed_beds_int > licensed_beds_int as staffed_exceeds_licensed_info from ({_inner})"
    if _name == "patients":
        _inner = f"select *, dense_rank() over (order by mpi_key) as canonical_patient_key from ({_inner})"
        CTES["people"] = _inner
    if _patient:
        _inner = (f'select v.*, k.canonical_patient_key from ({_inner}) v '
                  f'left join (select "Id" as pid, canonical_patient_key from people) k on k.pid = v.{_patient}')
    _cases = ", ".join(f"case when {cond} then '{msg}' end" for cond, msg in _rules)
    CTES[f"silver_{_name}"] = f"select *, _dq_issues = '' as _dq_passed from (select *, concat_ws('; ', {_cases}) as _dq_issues from ({_inner}))"

_minutes = "(epoch({b}) - epoch({a})) / 60"


def minutes(a: str, b: str) -> str:
    return f"(date_diff('second', {a}, {b}) / 60.0)"


def key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as integer)"


GOLD = {
    "dim_date": (f"""select {key('d')} as date_key, d as full_date, year(d) as year, month(d) as month, day(d) as day, dayofweek(d) + 1 as day_of_week,
        dayname(d) as day_name, monthname(d) as month_name, weekofyear(d) as iso_week, quarter(d) as quarter, dayofweek(d) in (0, 6) as is_weekend
        from (select cast(unnest(generate_series(date '2025-01-01', date '2027-12-31', interval 1 day)) as date) as d)""",
                 "date_key full_date:day year month day day_of_week day_name month_name iso_week quarter is_weekend"),
    "dim_facility": ("""select *, row_number() over (order by facility_id) as facility_key, facility_type_folded as ftype, emergency_services_bool as es
        from silver_facility where _dq_passed""", "facility_key facility_id facility_name city state zip county ownership"),
    "dim_unit": ("""select u.* exclude (is_critical_care, is_monitored, nurse_patient_ratio_target, unit_type), row_number() over (order by unit_id) as unit_key,
        facility_key, unit_type_folded as unit_type, nurse_patient_ratio_target_float as nurse_patient_ratio_target,
        is_critical_care_bool as is_critical_care, is_monitored_bool as is_monitored
        from silver_unit u left join (select facility_key, facility_id from dim_facility) f using (facility_id) where _dq_passed""",
                 "unit_key unit_id facility_key facility_id unit_code unit_name unit_type building floor nurse_patient_ratio_target is_critical_care is_monitored"),
    "dim_payer": ("""select row_number() over (order by payer_id) as payer_key, payer_id, payer_name, payer_type_folded as payer_type,
        claim_filing_indicator_code, share_float as share, prompt_pay_days_int as prompt_pay_days from silver_payer where _dq_passed""",
                  "payer_key payer_id payer_name payer_type claim_filing_indicator_code share prompt_pay_days"),
    "dim_drug": ("""select row_number() over (order by ndc11) as drug_key, ndc11, rxcui_scd, product_ndc, proprietary_name, non_proprietary_name, dosage_form_name,
        route_name, pharm_classes, dea_schedule, is_controlled_bool as is_controlled, is_shortage_prone_bool as is_shortage_prone,
        is_high_alert_bool as is_high_alert, unit_cost_float as unit_cost from silver_drug where _dq_passed""",
                 "drug_key ndc11 rxcui_scd product_ndc proprietary_name non_proprietary_name dosage_form_name route_name pharm_classes dea_schedule "
                 "is_controlled is_shortage_prone is_high_alert unit_cost:money"),
    "dim_staff": ("""select row_number() over (order by staff_id, valid_from) as staff_key, staff_id, npi, first_name, last_name, job_code, job_title,
        primary_facility_id, employment_type, fte_float as fte, is_active_bool as is_active, valid_from, valid_to, is_current
        from silver_staff where _dq_passed""",
                  "staff_key staff_id npi first_name last_name job_code job_title primary_facility_id employment_type fte is_active valid_from valid_to is_current"),
    "dim_patient": (f"""select row_number() over (order by canonical_patient_key) as patient_key, canonical_patient_key,
        case when a < 6570 then '0-17' when a < 12775 then '18-34' when a < 18250 then '35-49' when a < 23725 then '50-64' else '65+' end as age_band,
        "Gender", "Race", "Ethnicity", "Zip", is_high_risk_bool as is_high_risk, "Healthcare_Coverage_float" as insurance_type_placeholder
        from (select *, date_diff('day', "BirthDate_date", date '{AS_OF}') as a from silver_patients where _dq_passed
              qualify row_number() over (partition by canonical_patient_key order by "BirthDate_date", "Id" desc) = 1)""",
                    "patient_key canonical_patient_key age_band Gender Race Ethnicity Zip is_high_risk insurance_type_placeholder:money"),
    "dim_icd10": ("""select row_number() over (order by icd10_code) as icd10_key, icd10_code, icd10_description, icd_version_int as icd_version, code_chapter,
        hrrp_cohort, is_chronic_bool as is_chronic, readmission_risk_level from silver_icd10 where _dq_passed""",
                  "icd10_key icd10_code icd10_description icd_version code_chapter hrrp_cohort is_chronic readmission_risk_level"),
    "dim_drg": ("""select row_number() over (order by drg_code) as drg_key, drg_code, drg_description, relative_weight_float as relative_weight, severity_tier,
        drg_family, drg_type from silver_drg where _dq_passed""", "drg_key drg_code drg_description relative_weight severity_tier drg_family drg_type"),
    "fact_encounters": (f"""select "Id" as encounter_id, facility_key, unit_key, patient_key, {key('"Start_ts"')} as encounter_date_key, "Start_ts", "Stop_ts",
        "EncounterClass" as encounter_class, "Base_Encounter_Cost_float" as base_encounter_cost, "Total_Claim_Cost_float" as total_claim_cost
        from silver_encounters left join fkey using (facility_id) left join ukey using (unit_id) left join pkey using (canonical_patient_key) where _dq_passed""",
                        "encounter_id facility_key unit_key patient_key encounter_date_key Start_ts:time Stop_ts:time encounter_class base_encounter_cost:money total_claim_cost:money"),
    "fact_admissions": (f"""select hadm_id, encounter_id as source_encounter_id, facility_key, patient_key, {key('admittime_ts')} as admit_date_key,
        {key('dischtime_ts')} as discharge_date_key, admittime_ts, dischtime_ts, date_diff('second', admittime_ts, dischtime_ts) / 3600.0 as length_of_stay_hours,
        admission_type, admission_location, discharge_location, insurance, hospital_service, hospital_expire_flag_bool as hospital_expire_flag,
        is_readmission_bool as is_readmission, is_planned_readmission, drg_code, index_encounter_id
        from silver_admissions left join fkey using (facility_id) left join pkey using (canonical_patient_key) where _dq_passed""",
                        "hadm_id source_encounter_id facility_key patient_key admit_date_key discharge_date_key admittime_ts:time dischtime_ts:time length_of_stay_hours:rate "
                        "admission_type admission_location discharge_location insurance hospital_service hospital_expire_flag is_readmission is_planned_readmission drg_code index_encounter_id"),
    "fact_ed_stays": (f"""select stay_id, encounter_id as source_encounter_id, hadm_id, facility_key, patient_key, {key('intime_ts')} as stay_date_key, intime_ts, outtime_ts,
        {minutes('intime_ts', 'triage_time_ts')} as wait_time_minutes, {minutes('intime_ts', 'outtime_ts')} as length_of_stay_minutes, arrival_transport, disposition,
        acuity_int as acuity, heartrate from silver_ed_stays left join fkey using (facility_id) left join pkey using (canonical_patient_key) where _dq_passed""",
                      "stay_id source_encounter_id hadm_id facility_key patient_key stay_date_key intime_ts:time outtime_ts:time wait_time_minutes:rate length_of_stay_minutes:rate "
                      "arrival_transport disposition acuity heartrate"),
    "fact_outpatient_visits": (f"""select visit_id, encounter_id as source_encounter_id, facility_key, unit_key, patient_key, payer_key,
        {key('appointment_time_ts')} as visit_date_key, case when not is_no_show_bool then {minutes('arrival_time_ts', 'provider_seen_time_ts')} end as wait_time_minutes,
        case when not is_no_show_bool then {minutes('appointment_time_ts', 'provider_seen_time_ts')} end as appointment_delay_minutes, clinic_type,
        visit_status_folded as visit_status, is_no_show_bool as is_no_show, escalated_to_inpatient_bool as escalated_to_inpatient, primary_diagnosis_code
        from silver_outpatient_visits left join fkey using (facility_id) left join ukey using (unit_id) left join pkey using (canonical_patient_key)
        left join (select payer_key, payer_id from dim_payer) using (payer_id) where _dq_passed""",
                               "visit_id source_encounter_id facility_key unit_key patient_key payer_key visit_date_key wait_time_minutes:rate appointment_delay_minutes:rate "
                               "clinic_type visit_status is_no_show escalated_to_inpatient primary_diagnosis_code"),
    "fact_transfers": (f"""select transfer_id, hadm_id, facility_key, unit_key, patient_key, {key('intime_ts')} as transfer_date_key, intime_ts, outtime_ts,
        date_diff('second', intime_ts, outtime_ts) / 3600.0 as transfer_duration_hours, eventtype, careunit
        from silver_transfers left join fkey using (facility_id) left join ukey using (unit_id) left join pkey using (canonical_patient_key) where _dq_passed""",
                       "transfer_id hadm_id facility_key unit_key patient_key transfer_date_key intime_ts:time outtime_ts:time transfer_duration_hours:rate eventtype careunit"),
    "fact_diagnoses": ("""select hadm_id, encounter_id as source_encounter_id, facility_key, patient_key, seq_num_int as seq_num, icd_code, icd_version_int as icd_version,
        icd_title, hrrp_cohort from silver_diagnoses left join fkey using (facility_id) left join pkey using (canonical_patient_key) where _dq_passed""",
                       "hadm_id source_encounter_id facility_key patient_key seq_num icd_code icd_version icd_title hrrp_cohort"),
    "last_remit": ("""select * from silver_remit where _dq_passed qualify row_number() over (partition by patient_control_number order by remit_date desc nulls last,
        claim_status_code desc nulls last, total_claim_charge_amount desc nulls last, claim_payment_amount desc nulls last, patient_responsibility_amount desc nulls last,
        is_appealed desc nulls last, is_overturned_on_appeal desc nulls last, _batch_id desc nulls last) = 1""", ""),
    "fact_claims": (f"""select h.patient_control_number, h.encounter_id as source_encounter_id, h.hadm_id, facility_key, payer_key, patient_key, attending_staff_key,
        {key('submission_date_d')} as submission_date_key, total_charge_amount_float as total_charge_amount, r.claim_payment_amount_float as claim_payment_amount,
        total_charge_amount_float - coalesce(r.claim_payment_amount_float, 0) as amount_at_risk, coalesce(r.claim_payment_amount_float > 0, false) as is_paid,
        h.drg_code, type_of_bill, is_readmission_related_bool as is_readmission_related, r.claim_status_code as remit_claim_status_code,
        r.is_appealed_bool as is_appealed, r.is_overturned_on_appeal_bool as is_overturned_on_appeal, r.remit_date
        from silver_claim_header h left join last_remit r on r.patient_control_number = h.patient_control_number
        left join fkey using (facility_id) left join (select payer_key, payer_id as pay from dim_payer) on pay = h.payer_id
        left join pkey on pkey.canonical_patient_key = h.canonical_patient_key
        left join (select npi, min(staff_key) as attending_staff_key from dim_staff where is_current and npi is not null group by npi) s on s.npi = h.attending_provider_npi
        where h._dq_passed""",
                    "patient_control_number source_encounter_id hadm_id facility_key payer_key patient_key attending_staff_key submission_date_key total_charge_amount:money "
                    "claim_payment_amount:money amount_at_risk:money is_paid drg_code type_of_bill is_readmission_related remit_claim_status_code is_appealed is_overturned_on_appeal remit_date"),
    "fact_claim_lines": ("""select patient_control_number, line_control_number, revenue_code, line_charge_amount_float as line_charge_amount, unit_count_int as unit_count,
        non_covered_amount, service_date_from, service_date_to from silver_claim_line where _dq_passed""",
                         "patient_control_number line_control_number revenue_code line_charge_amount:money unit_count non_covered_amount service_date_from service_date_to"),
    "fact_claim_adjustments": ("""select patient_control_number, adjustment_seq, group_code, reason_code, amount_float as amount, remark_code, is_denial_bool as is_denial
        from silver_remit_adjustment where _dq_passed""", "patient_control_number adjustment_seq group_code reason_code amount:money remark_code is_denial"),
    "fact_bed_capacity": (f"""select facility_key, unit_key, {key('snapshot_datetime_ts')} as snapshot_date_key, hour(snapshot_datetime_ts) as snapshot_hour, snapshot_datetime_ts,
        {typed('int', 'licensed_beds')} as licensed_beds, staffed_beds_int as staffed_beds, blocked_beds_int as blocked_beds, occupied_beds_int as occupied_beds,
        available_beds_int as available_beds, occupancy_rate_float as occupancy_rate, is_at_capacity_bool as is_at_capacity,
        {typed('int', 'pending_admissions')} as pending_admissions, {typed('int', 'pending_discharges')} as pending_discharges
        from silver_bed_hourly left join fkey using (facility_id) left join ukey using (unit_id) where _dq_passed""",
                          "facility_key unit_key snapshot_date_key snapshot_hour snapshot_datetime_ts:time licensed_beds staffed_beds blocked_beds occupied_beds available_beds "
                          "occupancy_rate is_at_capacity pending_admissions pending_discharges"),
    "fact_pharmacy_inventory": (f"""select facility_key, drug_key, {key('snapshot_date_d')} as snapshot_date_key, counting_datetime, count_type, location_id,
        qty_on_hand_int as qty_on_hand, qty_on_order, reorder_point_int as reorder_point, safety_stock, avg_daily_usage_30d, days_on_hand,
        is_stockout_bool as is_stockout, shortage_status, unit_cost_float as unit_cost
        from silver_pharmacy_inventory left join fkey using (facility_id) left join (select drug_key, ndc11 from dim_drug) using (ndc11) where _dq_passed""",
                                "facility_key drug_key snapshot_date_key counting_datetime count_type location_id qty_on_hand qty_on_order reorder_point safety_stock "
                                "avg_daily_usage_30d days_on_hand is_stockout shortage_status unit_cost:money"),
    "fact_staffing": (f"""select facility_key, staff_key, unit_key, {key('work_date_parsed')} as work_date_key, unit_code, shift, shift_start, job_code,
        scheduled_hours_float as scheduled_hours, actual_hours_float as actual_hours, called_out, census
        from silver_staff_schedules left join fkey using (facility_id)
        left join (select unit_code, facility_id, min(unit_key) as unit_key from dim_unit group by all) using (unit_code, facility_id)
        left join (select staff_id, min(staff_key) as staff_key from dim_staff where is_current group by staff_id) using (staff_id) where _dq_passed""",
                      "facility_key staff_key unit_key work_date_key unit_code shift shift_start job_code scheduled_hours actual_hours called_out census"),
    "fkey": ("select facility_key, facility_id from dim_facility", ""),
    "ukey": ("select unit_key, unit_id from dim_unit", ""),
    "pkey": ("select patient_key, canonical_patient_key from dim_patient", ""),
}
GOLD["dim_facility"] = ("""select row_number() over (order by facility_id) as facility_key, facility_id, facility_name, facility_type_folded as facility_type, city, state, zip,
        county, emergency_services_bool as emergency_services, licensed_beds_int as licensed_beds, staffed_beds_int as staffed_beds, ownership
        from silver_facility where _dq_passed""",
                        "facility_key facility_id facility_name facility_type city state zip county emergency_services licensed_beds staffed_beds ownership")
GOLD["dim_unit"] = ("""select row_number() over (order by unit_id) as unit_key, unit_id, facility_key, facility_id, unit_code, unit_name, unit_type_folded as unit_type, building,
        floor, licensed_beds_int as licensed_beds, staffed_beds_int as staffed_beds, blocked_beds_int as blocked_beds,
        nurse_patient_ratio_target_float as nurse_patient_ratio_target, is_critical_care_bool as is_critical_care, is_monitored_bool as is_monitored
        from silver_unit left join fkey using (facility_id) where _dq_passed""",
                    "unit_key unit_id facility_key facility_id unit_code unit_name unit_type building floor licensed_beds staffed_beds blocked_beds nurse_patient_ratio_target "
                    "is_critical_care is_monitored")
for _name, (_sql, _) in GOLD.items():
    CTES[_name] = _sql


def gold_columns(name: str) -> list[tuple[str, str]]:
    out = []
    for entry in GOLD[name][1].split():
        column, _, kind = entry.partition(":")
        out.append((column, kind or "text"))
    return out


def _needs(sql: str) -> set[str]:
    return set(re.findall(r"\w+", sql)) & set(CTES)


def query(sql: str, **extra: str) -> str:
    """Prefix ``sql`` with the table expressions it reads, in dependency order."""
    every = {**CTES, **extra}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\w+", text)) & set(every)):
            if name not in order and text is not every[name]:
                visit(every[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    head = ",\n".join(f"{n} as ({every[n]})" for n in order)
    return f"with {head}\n{sql}" if order else sql


def silver_query(name: str) -> str:
    return query(f"select {', '.join(shown(k, c) for c, k in silver_columns(name))} from silver_{name}")


def gold_query(name: str) -> str:
    return query(f"select {', '.join(shown(k, c) for c, k in gold_columns(name))} from {name}")
