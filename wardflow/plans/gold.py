"""Gold: the star schema, built from rows that passed the gate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.functions.calendar import date_key, days, hours_between, minutes_between, with_calendar
from wardflow.functions.labels import age_band
from wardflow.functions.parsing import to_int
from wardflow.operators.dedupe import latest_child, latest_per_key
from wardflow.operators.joins import hot_key_join, lookup
from wardflow.operators.ordered import dense_number
from wardflow.operators.quality import gate
from wardflow.plans.silver import TABLES as SILVER
from wardflow.session import settle
from wardflow.sources.feeds import FEEDS
from wardflow.sources.layers import Layers

#: Span of the calendar dimension unless a build names another: wide enough for any date a feed may carry (73,414
#: days).  Facts outside it would vanish from trends; ``facts_without_date`` counts them.
CALENDAR = ("1900-01-01", "2100-12-31")


# The column names in the strings given to ``_renamed`` are the schemas of the star.
def _renamed(df: DataFrame, columns: str) -> DataFrame:
    """Select ``name`` or ``source:name`` entries, in order."""
    pairs = [entry.partition(":") for entry in columns.split()]
    return df.selectExpr(*[f"`{source}` AS `{name or source}`" for source, _, name in pairs])


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    return with_calendar(days(spark, first, last))


def _counted(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Surrogate numbers for dimensions the size of an organisation chart (buildings, insurers).
    Dimensions that grow with the business use ``dense_number``."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def dim_facility(facility: DataFrame) -> DataFrame:
    return _renamed(_counted(gate(facility), ["facility_id"], "facility_key"),
                    "facility_key facility_id facility_name facility_type_folded:facility_type city state zip "
                    "county emergency_services_bool:emergency_services licensed_beds_int:licensed_beds "
                    "staffed_beds_int:staffed_beds ownership")


def dim_unit(unit: DataFrame, facilities: DataFrame) -> DataFrame:
    keyed = lookup(gate(unit), facilities, "facility_id", ["facility_key"])
    return _renamed(dense_number(keyed, ["unit_id"], "unit_key"),
                    "unit_key unit_id facility_key facility_id unit_code unit_name unit_type_folded:unit_type "
                    "building floor licensed_beds_int:licensed_beds staffed_beds_int:staffed_beds "
                    "blocked_beds_int:blocked_beds nurse_patient_ratio_target_float:nurse_patient_ratio_target "
                    "is_critical_care_bool:is_critical_care is_monitored_bool:is_monitored")


def dim_payer(payer: DataFrame) -> DataFrame:
    return _renamed(_counted(gate(payer), ["payer_id"], "payer_key"),
                    "payer_key payer_id payer_name payer_type_folded:payer_type claim_filing_indicator_code "
                    "share_float:share prompt_pay_days_int:prompt_pay_days")


def dim_drug(drug: DataFrame) -> DataFrame:
    return _renamed(dense_number(gate(drug), ["ndc11"], "drug_key"),
                    "drug_key ndc11 rxcui_scd product_ndc proprietary_name non_proprietary_name dosage_form_name "
                    "route_name pharm_classes dea_schedule is_controlled_bool:is_controlled "
                    "is_shortage_prone_bool:is_shortage_prone is_high_alert_bool:is_high_alert "
                    "unit_cost_float:unit_cost abc_class")


def dim_staff(staff: DataFrame) -> DataFrame:
    """One key per version of a person's record."""
    return _renamed(dense_number(gate(staff), ["staff_id", "valid_from"], "staff_key"),
                    "staff_key staff_id npi first_name last_name job_code job_title credential "
                    "primary_facility_id primary_unit_id employment_type fte_float:fte hire_date "
                    "termination_date is_active_bool:is_active valid_from valid_to is_current")


def dim_patient(patients: DataFrame, as_of: str | None = None) -> DataFrame:
    """One de-identified row per person: the record with the earliest birth date stands for it."""
    person = latest_per_key(gate(patients), ["canonical_patient_key"], ["BirthDate_date ASC"])
    banded = person.withColumn("age_band", age_band("BirthDate_date", as_of or date.today().isoformat()))
    return _renamed(dense_number(banded, ["canonical_patient_key"], "patient_key", running=True),
                    "patient_key canonical_patient_key age_band Gender Race Ethnicity Zip "
                    "is_high_risk_bool:is_high_risk Healthcare_Coverage_float:insurance_type_placeholder")


def dim_icd10(icd10: DataFrame) -> DataFrame:
    return _renamed(dense_number(gate(icd10), ["icd10_code"], "icd10_key"),
                    "icd10_key icd10_code icd10_description icd_version_int:icd_version code_chapter "
                    "diagnosis_category care_setting hrrp_cohort is_chronic_bool:is_chronic "
                    "readmission_risk_level")


def dim_drg(drg: DataFrame) -> DataFrame:
    return _renamed(dense_number(gate(drg), ["drg_code"], "drg_key"),
                    "drg_key drg_code drg_description relative_weight_float:relative_weight severity_tier "
                    "drg_family drg_type")


class Gold:
    """Star schema over a supplier of Silver frames, built lazily and once per name.

    ``settled``: dimensions are written once and read by every fact that looks them up, for use without written layers.
    ``narrow``: supplies Silver rows with their verdict and the given columns only (``Silver.verdicts``), for ``columns``.
    """

    def __init__(self, spark: SparkSession, silver: Callable[[str], DataFrame], as_of: str | None = None,
                 calendar: tuple[str, str] = CALENDAR, settled: bool = False,
                 narrow: Callable[..., DataFrame] | None = None):
        self._spark, self._silver, self._as_of, self._calendar, self._settled = spark, silver, as_of, calendar, settled
        self._narrow = narrow
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            made = self._fact(name) if name in STAR else getattr(self, f"_{name}")()
            self._tables[name] = settle(made) if self._settled and name.startswith("dim_") else made
        return self._tables[name]

    def use(self, **tables: DataFrame) -> None:
        """Take these tables as they are instead of building them."""
        self._tables.update(tables)

    # dimensions
    def _dim_date(self) -> DataFrame:
        return dim_date(self._spark, *self._calendar)

    def _dim_facility(self) -> DataFrame:
        return dim_facility(self._silver("facility"))

    def _dim_unit(self) -> DataFrame:
        return dim_unit(self._silver("unit"), self.table("dim_facility"))

    def _dim_payer(self) -> DataFrame:
        return dim_payer(self._silver("payer"))

    def _dim_drug(self) -> DataFrame:
        return dim_drug(self._silver("drug"))

    def _dim_staff(self) -> DataFrame:
        return dim_staff(self._silver("staff"))

    def _dim_patient(self) -> DataFrame:
        return dim_patient(self._silver("patients"), self._as_of)

    def _dim_icd10(self) -> DataFrame:
        return dim_icd10(self._silver("icd10"))

    def _dim_drg(self) -> DataFrame:
        return dim_drg(self._silver("drg"))

    # lookups
    def _with_facility_key(self, df: DataFrame) -> DataFrame:
        return lookup(df, self.table("dim_facility"), "facility_id", ["facility_key"])

    def _with_unit_key(self, df: DataFrame) -> DataFrame:
        return lookup(df, self.table("dim_unit"), "unit_id", ["unit_key"])

    def _with_patient_key(self, df: DataFrame) -> DataFrame:
        return lookup(df, self.table("dim_patient"), "canonical_patient_key", ["patient_key"])

    def _with_payer_key(self, df: DataFrame) -> DataFrame:
        return lookup(df, self.table("dim_payer"), "payer_id", ["payer_key"])

    def _with_drug_key(self, df: DataFrame) -> DataFrame:
        return lookup(df, self.table("dim_drug"), "ndc11", ["drug_key"])

    def _with_attending_staff_key(self, df: DataFrame) -> DataFrame:
        attending = (self.table("dim_staff").filter("is_current AND npi IS NOT NULL")
                     .groupBy(F.col("npi").alias("attending_provider_npi"))
                     .agg(F.min("staff_key").alias("attending_staff_key")))
        # a missing provider is common: spread those rows
        return hot_key_join(df, attending, "attending_provider_npi", [None])

    def _with_shift_unit_key(self, df: DataFrame) -> DataFrame:
        units = (self.table("dim_unit").groupBy("unit_code", "facility_id").agg(F.min("unit_key").alias("shift_unit_key")))
        return lookup(df, units, ["unit_code", "facility_id"], ["shift_unit_key"])

    def _with_staff_key(self, df: DataFrame) -> DataFrame:
        staff = (self.table("dim_staff").filter("is_current").groupBy("staff_id")
                 .agg(F.min("staff_key").alias("staff_key")))
        return lookup(df, staff, "staff_id", ["staff_key"])

    def _with_remit(self, df: DataFrame, wanted: Sequence[str] | None) -> DataFrame:
        """The last passing remittance of each claim; both sides hold one row per claim number, so this join has no heavy key.

        The claims are those that passed, so a remittance without such a claim meets none, and the claims need not be judged once more for it.
        """
        entries = [e for e in REMIT.split() if wanted is None or e.rpartition(":")[2] in wanted]
        if self._narrow is None:
            rows = gate(self._silver("remit"))
        else:
            # ties between remittances are broken by their columns in order: those up to the last one needed decide
            raw, typed = FEEDS["remit"].columns, SILVER["remit"].typed
            sources = [e.partition(":")[0] for e in entries]
            last = max(raw.index(typed[c].raw if c in typed else c) for c in sources)
            read = dict.fromkeys([*raw[:last + 1], "patient_control_number", "remit_date", *sources])
            rows = gate(self._narrow("remit", list(read), met=["claim_header"])).select(*read)
        remit = _renamed(latest_child(rows, "patient_control_number", "remit_date"), " ".join(["patient_control_number", *entries]))
        return df.join(remit, "patient_control_number", "left")

    # facts
    def columns(self, name: str, columns: Sequence[str]) -> DataFrame:
        """A fact with ``columns`` only; what they do not need is neither read, shuffled nor looked up."""
        if self._narrow is None or name in self._tables:
            return self.table(name).select(*columns)
        return self._fact(name, columns)

    def _fact(self, name: str, wanted: Sequence[str] | None = None) -> DataFrame:
        fact = STAR[name]
        entries = [e for e in fact.columns.split() if wanted is None or (e.partition(":")[2] or e) in wanted]
        sources = [e.partition(":")[0] for e in entries]
        derived = {c: made for c, made in fact.derived.items() if c in sources}
        read = [*[c for c in sources if c not in derived], *[c for made in derived.values() for c in made.reads]]
        keys = [k for k in fact.keys if k in read]
        remit = [e.rpartition(":")[2] for e in REMIT.split() if name == "fact_claims" and e.rpartition(":")[2] in read]
        if wanted is None:
            df = gate(self._silver(fact.source))
        else:
            own = [c for c in read if c not in fact.keys and c not in remit]
            own += [c for k in keys for c in KEYS[k]] + ["patient_control_number"] * bool(remit)
            df = gate(self._narrow(fact.source, list(dict.fromkeys(own))))
        if remit:
            df = self._with_remit(df, None if wanted is None else remit)
        for key in keys:
            df = getattr(self, f"_with_{key}")(df)
        df = df.withColumns({c: made.make() for c, made in derived.items()})
        return _renamed(df, " ".join(entries)) if wanted is None else _renamed(df, " ".join(entries)).select(*wanted)


@dataclass(frozen=True)
class Made:
    """A column of a fact computed from the columns ``reads``."""

    make: Callable[[], Column]
    reads: tuple[str, ...]


def _day(column: str) -> Made:
    return Made(lambda: date_key(column), (column,))


def _span(between: Callable[[str, str], Column], start: str, end: str) -> Made:
    return Made(lambda: between(start, end), (start, end))


def _span_if_shown(start: str, end: str) -> Made:
    return Made(lambda: F.when(~F.col("is_no_show_bool"), minutes_between(start, end)), ("is_no_show_bool", start, end))


def _whole(column: str) -> Made:
    return Made(lambda: to_int(column), (column,))


@dataclass(frozen=True)
class Fact:
    """A fact: its Silver table, its columns (``name`` or ``source:name``), the keys looked up, the columns computed."""

    source: str
    columns: str
    keys: Sequence[str] = ()
    derived: Mapping[str, Made] = field(default_factory=dict)


#: Surrogate keys and the columns they are looked up by.
KEYS = {"facility_key": ["facility_id"], "unit_key": ["unit_id"], "patient_key": ["canonical_patient_key"], "payer_key": ["payer_id"],
        "drug_key": ["ndc11"], "attending_staff_key": ["attending_provider_npi"], "shift_unit_key": ["unit_code", "facility_id"],
        "staff_key": ["staff_id"]}

#: What a claim takes from its last remittance.
REMIT = ("claim_status_code:remit_claim_status_code claim_payment_amount_float:claim_payment_amount patient_responsibility_amount "
         "is_appealed_bool:is_appealed is_overturned_on_appeal_bool:is_overturned_on_appeal remit_date")

STAR = {
    "fact_encounters": Fact(
        "encounters", "Id:encounter_id facility_key unit_key patient_key encounter_date_key Start_ts Stop_ts EncounterClass:encounter_class "
        "Base_Encounter_Cost_float:base_encounter_cost Total_Claim_Cost_float:total_claim_cost Payer_Coverage:payer_coverage "
        "ReasonDescription",
        ["facility_key", "unit_key", "patient_key"],
        {"encounter_date_key": _day("Start_ts")}),
    "fact_admissions": Fact(
        "admissions", "hadm_id encounter_id:source_encounter_id facility_key patient_key admit_date_key discharge_date_key admittime_ts "
        "dischtime_ts length_of_stay_hours admission_type admission_location discharge_location insurance hospital_service "
        "hospital_expire_flag_bool:hospital_expire_flag is_readmission_bool:is_readmission is_planned_readmission drg_code "
        "index_encounter_id",
        ["facility_key", "patient_key"],
        {"admit_date_key": _day("admittime_ts"),
         "discharge_date_key": _day("dischtime_ts"),
         "length_of_stay_hours": _span(hours_between, "admittime_ts", "dischtime_ts")}),
    "fact_ed_stays": Fact(
        "ed_stays", "stay_id encounter_id:source_encounter_id hadm_id facility_key patient_key stay_date_key intime_ts outtime_ts "
        "wait_time_minutes length_of_stay_minutes arrival_transport disposition acuity_int:acuity chiefcomplaint temperature "
        "heartrate resprate o2sat sbp dbp pain",
        ["facility_key", "patient_key"],
        {"stay_date_key": _day("intime_ts"),
         "wait_time_minutes": _span(minutes_between, "intime_ts", "triage_time_ts"),
         "length_of_stay_minutes": _span(minutes_between, "intime_ts", "outtime_ts")}),
    "fact_outpatient_visits": Fact(
        "outpatient_visits", "visit_id encounter_id:source_encounter_id facility_key unit_key patient_key payer_key visit_date_key wait_time_minutes "
        "appointment_delay_minutes clinic_type visit_status_folded:visit_status is_no_show_bool:is_no_show "
        "escalated_to_inpatient_bool:escalated_to_inpatient primary_diagnosis_code",
        ["facility_key", "unit_key", "patient_key", "payer_key"],
        {"visit_date_key": _day("appointment_time_ts"),
         "wait_time_minutes": _span_if_shown("arrival_time_ts", "provider_seen_time_ts"),
         "appointment_delay_minutes": _span_if_shown("appointment_time_ts", "provider_seen_time_ts")}),
    "fact_transfers": Fact(
        "transfers", "transfer_id hadm_id facility_key unit_key patient_key transfer_date_key intime_ts outtime_ts transfer_duration_hours "
        "eventtype careunit",
        ["facility_key", "unit_key", "patient_key"],
        {"transfer_date_key": _day("intime_ts"),
         "transfer_duration_hours": _span(hours_between, "intime_ts", "outtime_ts")}),
    "fact_diagnoses": Fact(
        "diagnoses", "hadm_id encounter_id:source_encounter_id facility_key patient_key seq_num_int:seq_num icd_code "
        "icd_version_int:icd_version icd_title hrrp_cohort",
        ["facility_key", "patient_key"]),
    "fact_claims": Fact(
        "claim_header", "patient_control_number encounter_id:source_encounter_id hadm_id facility_key payer_key patient_key attending_staff_key "
        "submission_date_key total_charge_amount_float:total_charge_amount claim_payment_amount patient_responsibility_amount "
        "amount_at_risk is_paid drg_code type_of_bill admission_type_code is_readmission_related_bool:is_readmission_related "
        "remit_claim_status_code is_appealed is_overturned_on_appeal remit_date",
        ["facility_key", "payer_key", "patient_key", "attending_staff_key"],
        {"submission_date_key": _day("submission_date_d"),
         "is_paid": Made(lambda: F.coalesce(F.col("claim_payment_amount") > 0, F.lit(False)), ("claim_payment_amount",)),
         "amount_at_risk": Made(lambda: F.col("total_charge_amount_float") - F.coalesce("claim_payment_amount", F.lit(0).cast("decimal(18,2)")),
                               ("total_charge_amount_float", "claim_payment_amount"))}),
    "fact_claim_lines": Fact(
        "claim_line", "patient_control_number line_control_number revenue_code revenue_code_description procedure_code procedure_description "
        "line_charge_amount_float:line_charge_amount unit_count_int:unit_count non_covered_amount service_date_from "
        "service_date_to"),
    "fact_claim_adjustments": Fact(
        "remit_adjustment", "patient_control_number adjustment_seq group_code group_code_description reason_code reason_code_description "
        "amount_float:amount quantity remark_code remark_code_description is_denial_bool:is_denial"),
    "fact_bed_capacity": Fact(
        "bed_hourly", "facility_key unit_key snapshot_date_key snapshot_hour snapshot_datetime_ts licensed_beds staffed_beds_int:staffed_beds "
        "blocked_beds_int:blocked_beds occupied_beds_int:occupied_beds available_beds_int:available_beds "
        "occupancy_rate_float:occupancy_rate is_at_capacity_bool:is_at_capacity pending_admissions pending_discharges",
        ["facility_key", "unit_key"],
        {"snapshot_date_key": _day("snapshot_datetime_ts"),
         "snapshot_hour": Made(lambda: F.hour("snapshot_datetime_ts"), ("snapshot_datetime_ts",)),
         "licensed_beds": _whole("licensed_beds"),
         "pending_admissions": _whole("pending_admissions"),
         "pending_discharges": _whole("pending_discharges")}),
    "fact_pharmacy_inventory": Fact(
        "pharmacy_inventory", "facility_key drug_key snapshot_date_key counting_datetime count_type location_id qty_on_hand_int:qty_on_hand "
        "qty_on_order reorder_point_int:reorder_point safety_stock avg_daily_usage_30d days_on_hand "
        "is_stockout_bool:is_stockout shortage_status shortage_reason unit_cost_float:unit_cost extended_value",
        ["facility_key", "drug_key"],
        {"snapshot_date_key": _day("snapshot_date_d")}),
    "fact_staffing": Fact(
        "staff_schedules", "facility_key staff_key shift_unit_key:unit_key work_date_key unit_code shift shift_start shift_end job_code "
        "employment_type scheduled_hours_float:scheduled_hours actual_hours_float:actual_hours status overtime called_out "
        "floated_in census",
        ["facility_key", "shift_unit_key", "staff_key"],
        {"work_date_key": _day("work_date_parsed")}),
}

DIMENSIONS = ["dim_date", "dim_facility", "dim_unit", "dim_payer", "dim_drug", "dim_staff", "dim_patient",
              "dim_icd10", "dim_drg"]
FACTS = list(STAR)


def facts_without_date(fact: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Rows of a fact, those without a date key, and those whose key has no row in the calendar."""
    known = calendar.select(F.col("date_key").alias("_date_key"))
    return fact.join(known, F.col(key) == F.col("_date_key"), "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("without_key"),
        F.count_if(F.col(key).isNotNull() & F.col("_date_key").isNull()).alias("outside_calendar"))


def build_gold(spark: SparkSession, layers: Layers, as_of: str | None = None,
               names: Sequence[str] = tuple(DIMENSIONS + FACTS), calendar: tuple[str, str] = CALENDAR) -> None:
    """Write dimensions, then facts; each table reads the ones before it as written."""
    gold = Gold(spark, lambda name: layers.read(f"silver_{name}"), as_of, calendar)
    for name in names:
        gold._tables[name] = layers.overwrite(name, gold.table(name))
