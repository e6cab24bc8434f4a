"""Silver: typed, deduplicated, judged tables.

A table is declared once: which copy of a row survives, which typed siblings are added next to
the raw text, and which checks are run.  The messages are fixed values; they are what reports
filter on.  Money siblings keep the ``_float`` suffix users know but are exact decimals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.identity import mpi_key
from wardflow.functions.parsing import clinical_time, fold, to_bool, to_day, to_double, to_int, to_money, to_time
from wardflow.operators.audit import run_summary
from wardflow.operators.dedupe import drop_copies, latest_batch
from wardflow.operators.ordered import number_distinct
from wardflow.operators.quality import (ISSUES, PASSED, AttachKey, ForeignKey, Rule, at_most_times, in_domain, in_order, judge,
                                        no_more_than, parent_keys, parseable, required, resolve_keys, rule, tally, within)
from wardflow.operators.scd import versions
from wardflow.session import settle
from wardflow.sources.feeds import FEEDS
from wardflow.sources.layers import Layers

# Value domains after case folding.
FACILITY_TYPES = ["general acute care", "teaching", "regional", "community", "urgent care"]
ICD_VERSIONS = [9, 10]
VISIT_STATUSES = ["completed", "no show", "admitted"]
SEVERITY_TIERS = ["MCC", "CC", "NONE"]
MAX_CLAIM_CHARGE = 500000
MAX_PAID_RATIO = 5


@dataclass(frozen=True)
class SilverTable:
    name: str
    typed: Mapping[str, Typed]
    checks: Sequence[Rule | ForeignKey | AttachKey]
    pick: Callable[..., DataFrame] | None = None
    enrich: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)  # adds columns, keeps every row

    def base(self, bronze: DataFrame) -> DataFrame:
        """Surviving rows with typed siblings; enough for anyone who only needs the keys."""
        picked = self.pick(bronze) if self.pick else bronze
        return self.enrich(picked.withColumns({n: make() for n, make in self.typed.items()}))

    def reads(self) -> set[str] | None:
        """Columns that the verdict depends on; None where a rule does not tell."""
        rules = [c.reads if isinstance(c, Rule) else (c.column,) for c in self.checks]
        return None if None in rules else {column for read in rules for column in read}

    def narrow(self, bronze: DataFrame, columns: Iterable[str]) -> DataFrame:
        """The rows of ``base`` with ``columns`` only, none of which ``enrich`` adds; only what decides on them is shuffled."""
        columns = list(dict.fromkeys(columns))
        raw = {r for c in columns for r in (self.typed[c].reads if c in self.typed else (c,))}
        picked = self.pick(bronze, raw) if self.pick else bronze
        typed = picked.withColumns({n: make() for n, make in self.typed.items() if n in columns})
        return typed.select(*[f"`{c}`" for c in columns])


def _latest(name: str) -> Callable[..., DataFrame]:
    return lambda df, needed=None: latest_batch(df, FEEDS[name].keys, needed)


def _copies(name: str) -> Callable[..., DataFrame]:
    return lambda df, needed=None: drop_copies(df, FEEDS[name].keys, needed)


@dataclass(frozen=True)
class Typed:
    """A typed sibling of the column ``raw``."""

    make: Callable[..., Column]
    raw: str

    def __call__(self) -> Column:
        return self.make(self.raw)

    @property
    def reads(self) -> tuple[str, ...]:
        return (self.raw, "source_system") if self.make is clinical_time else (self.raw,)


def _typed(**makers: tuple[Callable[..., Column], str]) -> dict[str, Typed]:
    return {name: Typed(make, raw) for name, (make, raw) in makers.items()}


def _parsed_times(*columns: str) -> list[Rule]:
    """Times that are there but cannot be read are named and do not pass the gate."""
    return [parseable(c, f"{c}_ts") for c in columns]


def _facility(null_fails: bool = False) -> ForeignKey:
    return ForeignKey("facility_id", "facility", "facility_id",
                      "facility_id not found in silver_facility", null_fails=null_fails)


def _unit() -> ForeignKey:
    return ForeignKey("unit_id", "unit", "unit_id", "unit_id not found in silver_unit")


def _patient(column: str) -> AttachKey:
    return AttachKey(column, "patients", "Id", "canonical_patient_key",
                     f"{column} not found in silver_patients")


def _claim() -> ForeignKey:
    return ForeignKey("patient_control_number", "claim_header", "patient_control_number",
                      "patient_control_number not found in silver_claim_header", gated=True, large=True)


def _zero_beds() -> Column:
    beds = F.col("licensed_beds_int")
    return beds.isNull() | (beds < 0) | ((beds == 0) & (F.col("facility_type_folded") != "urgent care"))


def with_person(df: DataFrame) -> DataFrame:
    """Match key and dense person number.

    A demographic key made of blanks can be very common; both sides of the join are shuffled for
    it alone, so AQE can split such a key.
    """
    keyed = df.withColumn("mpi_key", mpi_key("SSN", "BirthDate", "Last", "First", "Zip"))
    return keyed.join(number_distinct(keyed, "mpi_key", "canonical_patient_key"), "mpi_key", "left")


def parse_work_date(df: DataFrame) -> DataFrame:
    return df.withColumn("work_date_parsed", to_day("work_date", "yyyy-MM-dd", "MM/dd/yyyy"))


def _one_shift(df: DataFrame, needed: Iterable[str] | None = None) -> DataFrame:
    """The same shift written in two date formats is one shift: dedupe on the parsed date."""
    return latest_batch(parse_work_date(df), ["facility_id", "staff_id", "work_date_parsed", "shift_start"], needed)


TABLES = {t.name: t for t in [
    SilverTable("facility", _typed(
        facility_type_folded=(fold, "facility_type"), emergency_services_bool=(to_bool, "emergency_services"),
        licensed_beds_int=(to_int, "licensed_beds"), staffed_beds_int=(to_int, "staffed_beds")),
        [required("facility_id"),
         in_domain("facility_type_folded", FACILITY_TYPES, "invalid facility_type"),
         rule("invalid licensed_beds", _zero_beds, ("licensed_beds_int", "facility_type_folded"))],
        _latest("facility"),
        # staffed above licensed happens in practice: reported, not failed
        lambda df: df.withColumn("staffed_exceeds_licensed_info",
                                 F.col("staffed_beds_int") > F.col("licensed_beds_int"))),
    SilverTable("unit", _typed(
        unit_type_folded=(fold, "unit_type"), licensed_beds_int=(to_int, "licensed_beds"),
        staffed_beds_int=(to_int, "staffed_beds"), blocked_beds_int=(to_int, "blocked_beds"),
        nurse_patient_ratio_target_float=(to_double, "nurse_patient_ratio_target"),
        is_critical_care_bool=(to_bool, "is_critical_care"), is_monitored_bool=(to_bool, "is_monitored")),
        [required("unit_id"), required("facility_id"),
         within("licensed_beds_int", 0, None, "invalid licensed_beds", null_fails=True),
         no_more_than("staffed_beds_int", "licensed_beds_int", "staffed_beds exceeds licensed_beds"),
         _facility()], _latest("unit")),
    SilverTable("payer", _typed(
        payer_type_folded=(fold, "payer_type"), share_float=(to_double, "share"),
        prompt_pay_days_int=(to_int, "prompt_pay_days")),
        [required("payer_id"), within("share_float", 0, 1, "share out of 0-1 range")], _latest("payer")),
    SilverTable("drug", _typed(
        is_controlled_bool=(to_bool, "is_controlled"), is_shortage_prone_bool=(to_bool, "is_shortage_prone"),
        is_high_alert_bool=(to_bool, "is_high_alert"), unit_cost_float=(to_money, "unit_cost"),
        usage_weight_float=(to_double, "usage_weight")),
        [required("ndc11"), within("unit_cost_float", 0, None, "invalid unit_cost", null_fails=True)],
        _latest("drug")),
    SilverTable("staff", _typed(fte_float=(to_double, "fte"), is_active_bool=(to_bool, "is_active")),
                [required("staff_id"),
                 rule("fte out of range", lambda: (F.col("fte_float") <= 0) | (F.col("fte_float") > 1), ("fte_float",))],
                None, lambda df: versions(df, "staff_id")),
    SilverTable("icd10", _typed(
        icd_version_int=(to_int, "icd_version"), is_chronic_bool=(to_bool, "is_chronic"),
        relative_frequency_float=(to_double, "relative_frequency")),
        [required("icd10_code"), in_domain("icd_version_int", ICD_VERSIONS, "invalid icd_version")],
        _latest("icd10")),
    SilverTable("drg", _typed(relative_weight_float=(to_double, "relative_weight")),
                [required("drg_code"), in_domain("severity_tier", SEVERITY_TIERS, "invalid severity_tier"),
                 within("relative_weight_float", 0, None, "invalid relative_weight", null_fails=True)],
                _latest("drg")),
    SilverTable("patients", _typed(
        BirthDate_date=(to_day, "BirthDate"), Healthcare_Expenses_float=(to_money, "Healthcare_Expenses"),
        Healthcare_Coverage_float=(to_money, "Healthcare_Coverage"), is_high_risk_bool=(to_bool, "is_high_risk")),
        [required("Id"), required("BirthDate_date", "BirthDate unparseable")],
        _latest("patients"), with_person),
    SilverTable("encounters", _typed(
        Start_ts=(clinical_time, "Start"), Stop_ts=(clinical_time, "Stop"),
        Base_Encounter_Cost_float=(to_money, "Base_Encounter_Cost"),
        Total_Claim_Cost_float=(to_money, "Total_Claim_Cost")),
        [required("Id", "encounter Id null"), in_order("Start_ts", "Stop_ts", "Stop before Start"),
         _facility(), _unit(), _patient("Patient"),
         *_parsed_times("Start", "Stop")], _latest("encounters")),
    SilverTable("admissions", _typed(
        admittime_ts=(clinical_time, "admittime"), dischtime_ts=(clinical_time, "dischtime"),
        is_readmission_bool=(to_bool, "is_readmission"),
        is_planned_readmission_bool=(to_bool, "is_planned_readmission"),
        hospital_expire_flag_bool=(to_bool, "hospital_expire_flag")),
        [required("hadm_id"), in_order("admittime_ts", "dischtime_ts", "dischtime before admittime"),
         _facility(), _patient("subject_id"),
         *_parsed_times("admittime", "dischtime")], _latest("admissions")),
    SilverTable("ed_stays", _typed(
        intime_ts=(clinical_time, "intime"), outtime_ts=(clinical_time, "outtime"), triage_time_ts=(clinical_time, "triage_time"),
        provider_seen_time_ts=(clinical_time, "provider_seen_time"),
        admit_decision_time_ts=(clinical_time, "admit_decision_time"), disposition_folded=(fold, "disposition"),
        acuity_int=(to_int, "acuity"), heartrate_int=(to_int, "heartrate")),
        [required("stay_id"), within("acuity_int", 1, 5, "acuity out of 1-5 range"), _facility(),
         in_order("intime_ts", "triage_time_ts", "triage_time before intime"),
         ForeignKey("hadm_id", "admissions", "hadm_id", "hadm_id not found in silver_admissions", large=True),
         _patient("subject_id"),
         *_parsed_times("intime", "outtime", "triage_time", "provider_seen_time", "admit_decision_time")], _latest("ed_stays")),
    SilverTable("outpatient_visits", _typed(
        appointment_time_ts=(clinical_time, "appointment_time"), arrival_time_ts=(clinical_time, "arrival_time"),
        provider_seen_time_ts=(clinical_time, "provider_seen_time"), departure_time_ts=(clinical_time, "departure_time"),
        visit_status_folded=(fold, "visit_status"), is_no_show_bool=(to_bool, "is_no_show"),
        escalated_to_inpatient_bool=(to_bool, "escalated_to_inpatient")),
        # arrival before the appointment is legal: no order check between the two
        [required("visit_id"), in_domain("visit_status_folded", VISIT_STATUSES, "invalid visit_status"),
         _facility(), _unit(),
         ForeignKey("encounter_id", "encounters", "Id", "encounter_id not found in silver_encounters", large=True),
         ForeignKey("payer_id", "payer", "payer_id", "payer_id not found in silver_payer"),
         ForeignKey("primary_diagnosis_code", "icd10", "icd10_code",
                    "primary_diagnosis_code not found in silver_icd10"),
         ForeignKey("seen_by_provider_id", "staff", "staff_id", "seen_by_provider_id not found in silver_staff",
                    large=True),
         _patient("subject_id"),
         *_parsed_times("appointment_time", "arrival_time", "provider_seen_time", "departure_time")], _latest("outpatient_visits")),
    SilverTable("transfers", _typed(intime_ts=(to_time, "intime"), outtime_ts=(to_time, "outtime")),
                [required("transfer_id"), _facility(), _unit(),
                 in_order("intime_ts", "outtime_ts", "outtime before intime"), _patient("subject_id")],
                _latest("transfers")),
    SilverTable("diagnoses", _typed(seq_num_int=(to_int, "seq_num"), icd_version_int=(to_int, "icd_version")),
                [required("icd_code"), in_domain("icd_version_int", ICD_VERSIONS, "invalid icd_version"),
                 _facility(), _patient("subject_id")], _latest("diagnoses")),
    SilverTable("claim_header", _typed(
        total_charge_amount_float=(to_money, "total_charge_amount"), submission_date_d=(to_day, "submission_date"),
        is_readmission_related_bool=(to_bool, "is_readmission_related")),
        [required("patient_control_number"),
         within("total_charge_amount_float", 0, None, "invalid total_charge_amount", null_fails=True),
         _facility(),
         ForeignKey("payer_id", "payer", "payer_id", "payer_id not found in silver_payer", null_fails=True),
         within("total_charge_amount_float", None, MAX_CLAIM_CHARGE,
                "total_charge_amount implausibly large for a single claim"),
         ForeignKey("attending_provider_npi", "staff", "npi", "attending_provider_npi not found in silver_staff",
                    large=True),
         _patient("subject_id")], _latest("claim_header")),
    SilverTable("claim_line", _typed(
        line_charge_amount_float=(to_money, "line_charge_amount"), unit_count_int=(to_int, "unit_count")),
        [required("patient_control_number"), _claim()], _latest("claim_line")),
    SilverTable("remit", _typed(
        claim_payment_amount_float=(to_money, "claim_payment_amount"),
        total_claim_charge_amount_float=(to_money, "total_claim_charge_amount"),
        remit_date_d=(to_day, "remit_date"), is_appealed_bool=(to_bool, "is_appealed"),
        is_overturned_on_appeal_bool=(to_bool, "is_overturned_on_appeal")),
        [required("patient_control_number"), _claim(),
         at_most_times("claim_payment_amount_float", "total_claim_charge_amount_float", MAX_PAID_RATIO,
                       "claim_payment_amount implausibly larger than total_claim_charge_amount")]),
    SilverTable("remit_adjustment", _typed(amount_float=(to_money, "amount"), is_denial_bool=(to_bool, "is_denial")),
                [required("patient_control_number"), _claim()], _latest("remit_adjustment")),
    SilverTable("bed_hourly", _typed(
        snapshot_datetime_ts=(to_time, "snapshot_datetime"), staffed_beds_int=(to_int, "staffed_beds"),
        blocked_beds_int=(to_int, "blocked_beds"), occupied_beds_int=(to_int, "occupied_beds"),
        available_beds_int=(to_int, "available_beds"), occupancy_rate_float=(to_double, "occupancy_rate"),
        is_at_capacity_bool=(to_bool, "is_at_capacity")),
        [required("snapshot_datetime_ts", "snapshot_datetime unparseable"),
         within("occupancy_rate_float", 0, 1, "occupancy_rate out of 0-1 range"), _facility(), _unit()],
        _copies("bed_hourly")),
    SilverTable("bed_nhsn", _typed(
        week_ending_date_d=(to_day, "week_ending_date"), collection_date_d=(to_day, "collection_date"),
        all_hospital_inpatient_beds_int=(to_int, "all_hospital_inpatient_beds"),
        all_hospital_inpatient_occupancy_int=(to_int, "all_hospital_inpatient_occupancy")),
        [required("week_ending_date_d", "week_ending_date unparseable"),
         no_more_than("all_hospital_inpatient_occupancy_int", "all_hospital_inpatient_beds_int",
                      "occupancy exceeds bed count"),
         ForeignKey("facility_name", "facility", "facility_name", "facility_name not found in silver_facility")]),
    SilverTable("pharmacy_inventory", _typed(
        snapshot_date_d=(to_day, "snapshot_date"), qty_on_hand_int=(to_int, "qty_on_hand"),
        reorder_point_int=(to_int, "reorder_point"), days_on_hand_float=(to_double, "days_on_hand"),
        avg_daily_usage_30d_float=(to_double, "avg_daily_usage_30d"), unit_cost_float=(to_money, "unit_cost"),
        is_stockout_bool=(to_bool, "is_stockout"), is_controlled_bool=(to_bool, "is_controlled")),
        [required("ndc11"), within("qty_on_hand_int", 0, None, "invalid qty_on_hand", null_fails=True), _facility()],
        _copies("pharmacy_inventory")),
    SilverTable("staff_schedules", _typed(
        scheduled_hours_float=(to_double, "scheduled_hours"), actual_hours_float=(to_double, "actual_hours"),
        census_int=(to_int, "census")),
        [required("staff_id"), required("facility_id"),
         required("work_date_parsed", "work_date unparseable"), _facility(),
         ForeignKey("staff_id", "staff", "staff_id", "staff_id not found in silver_staff")],
        _one_shift),
]}

# Parents before children.
BUILD_ORDER = ["facility", "unit", "payer", "drug", "staff", "icd10", "drg", "patients", "encounters",
               "admissions", "ed_stays", "outpatient_visits", "transfers", "diagnoses", "claim_header",
               "claim_line", "remit", "remit_adjustment", "bed_hourly", "bed_nhsn", "pharmacy_inventory",
               "staff_schedules"]


# Looked up by most other tables and costly to derive (person matching, version validity).
SETTLED = ("patients", "staff")


#: Parents of which only rows that passed count, and the keys by which.
GATED: dict[str, list[str]] = {}
for _table in TABLES.values():
    for _check in _table.checks:
        if isinstance(_check, ForeignKey) and _check.gated and _check.parent_column not in GATED.setdefault(_check.parent, []):
            GATED[_check.parent].append(_check.parent_column)


def _only_exists(check: Rule | ForeignKey | AttachKey) -> Rule | ForeignKey:
    """The check without the value it brings over."""
    if isinstance(check, AttachKey):
        return ForeignKey(check.column, check.parent, check.parent_column, check.message, null_fails=True, large=True)
    return check


class Silver:
    """Silver tables over a supplier of Bronze frames, built lazily and once per name.

    For use without written layers; the tables in ``SETTLED`` are computed once and kept in the
    shared folder instead of being repeated inside every plan that looks them up. So are the key values of every
    parent, which are all that a foreign key asks for; ``verdicts`` needs no more.
    """

    def __init__(self, bronze: Callable[[str], DataFrame]):
        self._bronze = bronze
        self._bases: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        self._known: dict[tuple[str, str, bool], DataFrame] = {}
        self._judged: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._bases:
            base = TABLES[name].base(self._bronze(name))
            self._bases[name] = settle(base) if name in SETTLED else base
        return self._bases[name]

    def parent(self, name: str, gated: bool) -> DataFrame:
        return self.table(name) if gated else self.base(name)

    def known(self, item: ForeignKey) -> DataFrame:
        """Distinct values of a parent's key, computed once for all children.

        Choosing one of the rows that share a key keeps every value of that key, so the rows need not be chosen for it.
        """
        key = (item.parent, item.parent_column, item.gated)
        if key not in self._known:
            parent = TABLES[item.parent]
            every_value = parent.pick is None or item.parent_column in FEEDS[item.parent].keys
            if item.gated:
                rows = self.judged(item.parent)
            elif item.parent in SETTLED and item.parent in self._bases or not every_value:
                rows = self.base(item.parent)
            else:
                rows = self._bronze(item.parent)
            self._known[key] = settle(parent_keys(item, rows))
        return self._known[key]

    def judged(self, name: str) -> DataFrame:
        """Verdicts of a parent with the keys that gated foreign keys ask for, computed once for its children and for who counts them."""
        if name not in self._judged:
            self._judged[name] = settle(self.verdicts(name, GATED[name]))
        return self._judged[name]

    def counts(self, name: str) -> DataFrame:
        """How many rows (``rows``) of ``table`` have each verdict."""
        table = TABLES[name]
        if name in GATED or table.reads() is None:
            rows = self.judged(name) if name in GATED else self.table(name)
            return rows.groupBy(ISSUES, PASSED).agg(F.count(F.lit(1)).alias("rows"))
        return tally(table.narrow(self._bronze(name), sorted(table.reads())), [_only_exists(c) for c in table.checks], self.known)

    def columns(self, name: str, columns: Sequence[str]) -> DataFrame:
        """``base(name)`` with ``columns`` only, none of which ``enrich`` adds; from narrower rows than ``base`` chooses among."""
        return TABLES[name].narrow(self._bronze(name), columns)

    def verdicts(self, name: str, columns: Sequence[str] = (), met: Sequence[str] = ()) -> DataFrame:
        """The rows of ``table`` with their verdict and, of their other columns, ``columns`` only.

        ``met``: parents whose passing rows the caller joins the result with by the key that is checked. A row without such a parent
        finds no partner there, so whether it has one is not judged here.

        Makes no more than that takes: columns that neither decide which copy survives nor how it is judged are not
        shuffled, and a parent whose value is not asked for (a person always has a number) only has to exist.
        """
        table = TABLES[name]
        asked = [c for c in table.checks if isinstance(c, Rule) or c.parent not in met]
        reads, brought = table.reads(), {c.brings for c in table.checks if isinstance(c, AttachKey)}
        own = [c for c in columns if c not in brought]
        if reads is None or not set(own) <= {*FEEDS[name].columns, *table.typed, "_batch_id", "work_date_parsed"}:
            return self.table(name).select(*columns, ISSUES, PASSED)
        checks = [c if isinstance(c, AttachKey) and c.brings in columns else _only_exists(c) for c in asked]
        keyed, rules = resolve_keys(table.narrow(self._bronze(name), [*own, *sorted(reads)]), checks, self.parent, self.known)
        return judge(keyed, rules).select(*columns, ISSUES, PASSED)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = judge_table(name, self.base(name), self.parent, known=self.known)
        return self._tables[name]


def judge_table(name: str, base: DataFrame, parents: Callable[[str, bool], DataFrame], raw: DataFrame | None = None,
                known: Callable[[ForeignKey], DataFrame] | None = None) -> DataFrame:
    """Rows with their verdict (``raw``, the rows before typing, is accepted for callers that pass it and not needed)."""
    keyed, rules = resolve_keys(base, TABLES[name].checks, parents, known)
    judged = judge(keyed, rules)
    return judged.select(*[c for c in judged.columns if not c.startswith("_fk")])


def build_silver(layers: Layers, names: Sequence[str] = tuple(BUILD_ORDER), run_id: str | None = None) -> None:
    """Write the Silver tables, parents first; each child reads its parents as written.

    The run log is taken from the written table, so nothing is computed twice.
    """
    for name in names:
        bronze = layers.read(f"bronze_{name}")
        judged = judge_table(name, TABLES[name].base(bronze),
                             lambda parent, gated: layers.read(f"silver_{parent}"))
        written = layers.overwrite(f"silver_{name}", judged)
        layers.append("dq_run_results", run_summary(written, f"silver_{name}", run_id or ""))
