"""Derive all-string hospital feeds from the supplied business tables.

Orders become encounters, admissions, ED stays, visits and claims; line items become transfers,
diagnoses, claim lines, remittances, inventory counts and shifts; events become bed snapshots
and monitor readings; customers, suppliers, parts and nations become patients, units and staff,
drugs and facilities.  Defects are planted by arithmetic on keys, so every feed has a known
share of each defect class and all of it grows with the tables.

A feed is one SELECT, written once for both SQL dialects: ``Dialect`` holds the few spellings
that differ.  Spark runs it to obtain Bronze; the expected results use the same text as their
first common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wardflow.session import settle
from wardflow.sources.feeds import FEEDS, conform

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class Dialect:
    """Spark spelling; ``DuckDb`` overrides."""

    formats = {"iso": "yyyy-MM-dd", "us": "MM/dd/yyyy", "compact": "yyyyMMdd"}

    def table(self, name: str) -> str:
        return "{" + name + "}"

    def stamp(self, base: str, minutes: str) -> str:
        return (f"date_format(timestampadd(MINUTE, cast({minutes} as int), cast({base} as timestamp)), "
                f"'yyyy-MM-dd HH:mm:ss')")

    def day(self, base: str, add: str = "0", form: str = "iso") -> str:
        at = f"date_add(cast({base} as date), cast({add} as int))"
        text = f"date_format({at}, '{self.formats[form]}')"
        if form != "compact":
            return text
        # the digits of a number are made in a tenth of the time a formatter takes
        return (f"case when year({at}) between 1000 and 9999 then cast(year({at}) * 10000 + month({at}) * 100 + day({at}) as string) "
                f"else {text} end")

    def idiv(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))"

    def joined(self, name: str, sql: str) -> str:
        """A join that several feeds are made from, under its name."""
        return f"({sql}) {name}"

    def iso(self, t: str) -> str:
        return f"date_format(cast({t} as timestamp), 'yyyy-MM-dd HH:mm:ss')"

    def clinical(self, base: str, minutes: str) -> str:
        """A time as the supplier's nation has its system write it: ISO, with a T, day first, month first."""
        at = f"timestampadd(MINUTE, cast({minutes} as int), cast({base} as timestamp))"
        return (f"case s_nationkey % 4 when 1 then concat(date_format({at}, 'yyyy-MM-dd'), 'T', date_format({at}, 'HH:mm:ss')) "
                f"when 2 then date_format({at}, 'dd/MM/yyyy HH:mm') when 3 then date_format({at}, 'MM/dd/yyyy HH:mm') "
                f"else date_format({at}, 'yyyy-MM-dd HH:mm:ss') end")

    def twice(self, test: str) -> str:
        """0 for every row, and 0 and 1 where ``test`` holds."""
        return f"explode(case when {test} then array(0, 1) else array(0) end)"


class Shared(Dialect):
    """Spark spelling in which joins are named like tables; ``joins`` has their text."""

    def __init__(self):
        self.joins: dict[str, str] = {}

    def joined(self, name: str, sql: str) -> str:
        self.joins[f"joined_{name}"] = sql
        return f"{{joined_{name}}} {name}"


class DuckDb(Dialect):
    formats = {"iso": "%Y-%m-%d", "us": "%m/%d/%Y", "compact": "%Y%m%d"}

    def table(self, name: str) -> str:
        return name

    def stamp(self, base: str, minutes: str) -> str:
        return f"strftime({base} + to_minutes(cast({minutes} as bigint)), '%Y-%m-%d %H:%M:%S')"

    def day(self, base: str, add: str = "0", form: str = "iso") -> str:
        return f"strftime(cast({base} as date) + cast({add} as int), '{self.formats[form]}')"

    def idiv(self, a: str, b: str) -> str:
        return f"(({a}) // ({b}))"

    def iso(self, t: str) -> str:
        return f"strftime({t}, '%Y-%m-%d %H:%M:%S')"

    def clinical(self, base: str, minutes: str) -> str:
        at = f"({base} + to_minutes(cast({minutes} as bigint)))"
        return (f"case s_nationkey % 4 when 1 then strftime({at}, '%Y-%m-%dT%H:%M:%S') when 2 then strftime({at}, '%d/%m/%Y %H:%M') "
                f"when 3 then strftime({at}, '%m/%d/%Y %H:%M') else strftime({at}, '%Y-%m-%d %H:%M:%S') end")

    def twice(self, test: str) -> str:
        return f"unnest(case when {test} then [0, 1] else [0] end)"


def text(e: str) -> str:
    return f"cast({e} as string)"


def padded(e: str, n: int) -> str:
    return f"lpad({text(e)}, {n}, '0')"


def money(e: str) -> str:
    return text(f"cast({e} as decimal(18,2))")


ICD = ["A41.9", "I50.23", "J44.1", "J18.9", "I21.4", "E11.22", "E11.65", "N17.9", "I10", "R07.9", "K92.2", "Z99.8"]
COHORT = ["OTHER", "HF", "COPD", "PN", "AMI", "OTHER", "OTHER", "OTHER", "OTHER", "OTHER", "OTHER", "OTHER"]


def choose(e: str, values: list[str]) -> str:
    """Pick by ``e`` modulo the number of values."""
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case ({e}) % {len(values)} {whens} else '{values[-1]}' end"


def feeds(d: Dialect) -> dict[str, str]:
    t = d.table
    facility, staff = padded("s_nationkey", 6), f"'STF' || {padded('s_suppkey', 6)}"
    unit = f"{facility} || '-U' || {text('s_suppkey')}"
    unit_code = f"{choose('s_suppkey', ['MICU', 'SICU', 'NICU', 'PEDS', 'TELE', 'MS', 'ED', 'OPC'])} || {text('s_suppkey')}"
    patient, enc = f"'P' || {padded('o_custkey', 9)}", f"'ENC' || {padded('o_orderkey', 9)}"
    hadm, pcn = f"'HADM' || {padded('o_orderkey', 9)}", f"'PCN' || {padded('o_orderkey', 9)}"
    admitted = "o_orderpriority in ('1-URGENT', '2-HIGH')"
    system = choose("s_nationkey", ["CENTRAL_HIS", "ACADEMIC_CIS", "REGIONAL_HIS", "COMMUNITY_CARE_EHR"])
    o = d.joined("o", f"select x.*, s_suppkey, s_nationkey, c_nationkey, c_mktsegment, o_orderkey % 1440 as minute from "
                 f"(select o.*, o_orderkey % (select count(*) from {t('supplier')}) as sk from {t('orders')} o) x "
                 f"join {t('supplier')} on s_suppkey = sk join {t('customer')} on c_custkey = o_custkey")
    l = d.joined("l", f"select l.*, s_suppkey, s_nationkey, o_orderkey, o_custkey, o_orderpriority, o_orderdate from {t('lineitem')} l "
                 f"join {t('supplier')} on s_suppkey = l_suppkey join {t('orders')} on o_orderkey = l_orderkey")
    e = (f"(select e.*, s_suppkey, s_nationkey, date_trunc('hour', ts) as hr, 10 + s_suppkey % 40 - s_suppkey % 3 as staffed, "
         f"s_suppkey % 3 as blocked, event_id % (14 + s_suppkey % 40) as occupied from "
         f"(select e.*, user_id % (select count(*) from {t('supplier')}) as sk from {t('events')} e) e "
         f"join {t('supplier')} on s_suppkey = sk) e")
    icd, cohort = choose("l_partkey", ICD), choose("l_partkey", COHORT)
    payer = "'PAY-' || substr(c_mktsegment, 1, 3)"
    out = {}
    out["facility"] = f"""
        select {padded('n_nationkey', 6)} as facility_id, n_name as facility_name,
          case when n_nationkey = 5 then 'Clinic' else
            {choose('n_nationkey', ['General Acute Care', ' Teaching', 'REGIONAL', 'Community', 'Urgent Care', 'teaching '])} end as facility_type,
          r_name as region, n_name || ' City' as city, substr(r_name, 1, 2) as state, {padded('n_nationkey', 5)} as zip,
          'County' as county, case when n_nationkey % 6 = 4 then '0' else '1' end as emergency_services,
          case when n_nationkey % 6 = 4 then '0' when n_nationkey = 8 then '0' else {text('100 + n_nationkey * 20')} end as licensed_beds,
          {text('120 + n_nationkey * 15 + b')} as staffed_beds, 'Non-profit' as ownership,
          case when b = 0 then '20240101' else '20240108' end as _batch_id
        from (select *, {d.twice('n_nationkey % 2 = 0')} as b from {t('nation')}) n join {t('region')} on r_regionkey = n_regionkey"""
    out["unit"] = f"""
        select {unit} as unit_id, case when s_suppkey % 37 = 1 then {facility} || '-ORPHAN' else {facility} end as facility_id,
          {unit_code} as unit_code, 'Unit ' || {text('s_suppkey')} as unit_name,
          {choose('s_suppkey', ['Intensive Care', ' ICU', 'NICU', 'Pediatrics', 'Telemetry', 'Med-Surg', 'Emergency', 'Outpatient Clinic'])} as unit_type,
          'B' || {text('s_suppkey % 4')} as building, {text('s_suppkey % 9')} as floor,
          case when s_suppkey % 31 = 3 then '-4' else {text('10 + s_suppkey % 40')} end as licensed_beds,
          case when s_suppkey % 29 = 2 then {text('20 + s_suppkey % 40')} else {text('10 + s_suppkey % 40 - s_suppkey % 3')} end as staffed_beds,
          {text('s_suppkey % 3')} as blocked_beds, {choose('s_suppkey', ['2', '2', '2', '4', '4', '5', '4', '5.0'])} as nurse_patient_ratio_target,
          case when s_suppkey % 8 < 3 then '1' else '0' end as is_critical_care, case when s_suppkey % 8 < 5 then '1' else '0' end as is_monitored,
          '20240101' as _batch_id
        from {t('supplier')}"""
    out["payer"] = f"""
        select {payer} as payer_id, c_mktsegment as payer_name,
          case when c_mktsegment < 'C' then ' Commercial' else 'Medicare' end as payer_type, 'CI' as claim_filing_indicator_code,
          case when c_mktsegment = 'HOUSEHOLD' then '1.4' else '0.2' end as share, '30' as prompt_pay_days, '20240101' as _batch_id
        from (select distinct c_mktsegment from {t('customer')}) c"""
    out["drug"] = f"""
        select {text('p_partkey')} as rxcui_scd, {padded('p_partkey', 11)} as ndc11, {padded('p_partkey', 8)} as product_ndc,
          upper(p_name) as proprietary_name, p_name as non_proprietary_name, p_type as dosage_form_name, p_brand as route_name,
          p_type || ' class' as pharm_classes, case when p_size % 7 = 0 then 'CII' end as dea_schedule,
          case when p_size % 7 = 0 then '1' else '0' end as is_controlled,
          case when p_partkey % 53 = 2 then '-1.00' when p_partkey % 59 = 3 then '12.5 mg' else {money('p_retailprice')} end as unit_cost,
          {text('p_size')} as usage_weight, case when p_size % 5 = 0 then '1' else '0' end as is_shortage_prone,
          case when p_size % 9 = 0 then 'true' else 'false' end as is_high_alert,
          case when b = 0 then '20240101' else '20240108' end as _batch_id
        from (select *, {d.twice('p_partkey % 10 = 7')} as b from {t('part')}) p"""
    out["staff"] = f"""
        select 'STF' || {padded('sk', 6)} as staff_id, case when sk % 4 <> 0 then '1' || {padded('sk', 9)} end as npi,
          'First' || {text('sk')} as first_name, 'Last' || {text('sk % 17')} as last_name,
          {choose('n', ['RN', 'LPN', 'MD'])} as job_code, 'Nurse' as job_title, {padded('sk % 25', 6)} as primary_facility_id,
          '1' as employment_type, case when sk % 17 = 4 then '1.5' else '0.8' end as fte,
          case when y < 2001 then '1' else '0' end as is_active, {text('y')} || '0101' as _batch_id
        from (select l_suppkey as sk, year(l_shipdate) as y, count(*) as n from {t('lineitem')} group by l_suppkey, year(l_shipdate)) v"""
    out["patients"] = f"""
        select 'P' || {padded('c_custkey', 9)} as "Id",
          case when c_custkey % 97 = 5 then 'unknown' else {d.day("date '1930-01-01'", 'c_custkey * 37 % 33000')} end as "BirthDate",
          case c_custkey % 5 when 0 then ' ' when 1 then null else 'S' || {text('c_custkey - c_custkey % 10')} || {text('c_nationkey % 7')} end as "SSN",
          'F' || {text('c_custkey % 5')} as "First", 'L' || {text('c_custkey % 3')} as "Last",
          {choose('c_custkey', ['white', 'black', 'asian'])} as "Race", {choose('c_custkey', ['hispanic', 'nonhispanic'])} as "Ethnicity",
          {choose('c_custkey', ['M', 'F'])} as "Gender", {padded('c_nationkey + b', 5)} as "Zip",
          {money('c_acctbal')} as "Healthcare_Expenses", {money('c_acctbal')} as "Healthcare_Coverage",
          case when c_acctbal < 0 then '1' else '0' end as is_high_risk, 'MRN' || {text('c_custkey % 400')} as mrn,
          {padded('c_nationkey', 6)} as source_facility_id, case when b = 0 then '20240101' else '20240108' end as _batch_id
        from (select *, {d.twice('c_custkey % 10 = 3')} as b from {t('customer')}) c"""
    out["encounters"] = f"""
        select {enc} as "Id", {d.clinical('o_orderdate', 'minute')} as "Start",
          {d.clinical('o_orderdate', 'case when o_orderkey % 101 = 7 then minute - 60 else minute + 30 + o_orderkey * 7 % 4000 end')} as "Stop",
          case when o_orderkey % 113 = 2 then {patient} || '-ORPHAN' else {patient} end as "Patient",
          {choose('o_orderkey', ['outpatient', 'EMERGENCY', 'Inpatient', 'Ambulatory', 'urgentcare'])} as "EncounterClass",
          {money('o_totalprice')} as "Base_Encounter_Cost",
          case when o_orderkey % 71 = 9 then {money('o_totalprice')} || ' mg' else {money('o_totalprice')} end as "Total_Claim_Cost",
          case when o_orderkey % 127 = 3 then '999999' else {facility} end as facility_id,
          case when o_orderkey % 3 = 0 then null when o_orderkey % 89 = 1 then 'NO-UNIT' else {unit} end as unit_id,
          'MRN' || {text('o_custkey % 400')} as mrn, {system} as source_system, {d.day('o_orderdate', form='compact')} as _batch_id
        from {o}"""
    stay_minutes = "1440 * (1 + o_orderkey % 12) + o_orderkey * 13 % 600"
    out["admissions"] = f"""
        select {patient} as subject_id, {hadm} as hadm_id, {d.clinical('o_orderdate', 'minute')} as admittime,
          case when o_orderkey % 59 = 1 then null
            else {d.clinical('o_orderdate', f'case when o_orderkey % 83 = 4 then minute - 90 else minute + {stay_minutes} end')} end as dischtime,
          o_orderpriority as admission_type, 'ED' as admission_location,
          case when o_orderkey % 19 = 0 then 'AGAINST ADVICE' else 'HOME' end as discharge_location, 'Medicare' as insurance,
          case when o_orderkey % 23 = 0 then '1' else '0' end as hospital_expire_flag,
          case when o_orderkey % 131 = 5 then 'F000' else {facility} end as facility_id,
          case when o_orderkey % 11 = 0 then 'PSYCH' else 'MED' end as hospital_service,
          case when o_orderkey % 6 = 1 then '1' else '0' end as is_readmission,
          case when o_orderkey % 7 = 0 then '1' else '0' end as is_planned_readmission,
          case when o_orderkey % 6 = 1 then 'ENC' || {padded('o_orderkey - 1 - o_orderkey % 4', 9)} end as index_encounter_id,
          {enc} as encounter_id, {padded('o_orderkey % 6 * 3 + o_orderkey % 3', 3)} as drg_code, {system} as source_system,
          {d.day('o_orderdate', form='compact')} as _batch_id
        from {o} where {admitted}"""
    out["ed_stays"] = f"""
        select {patient} as subject_id, 'STAY' || {padded('o_orderkey', 9)} as stay_id, {enc} as encounter_id,
          case when o_orderpriority = '2-HIGH' then {hadm} when o_orderkey % 61 = 8 then 'HADM-ORPHAN' end as hadm_id,
          case when o_orderkey % 149 = 3 then 'this morning' else {d.clinical('o_orderdate', 'minute')} end as intime,
          {d.clinical('o_orderdate', 'case when o_orderkey % 89 = 1 then minute - 45 else minute + 60 + o_orderkey * 13 % 600 end')} as outtime,
          {choose('o_orderkey', ['AMBULANCE', 'WALK IN'])} as arrival_transport,
          case when o_orderpriority = '2-HIGH' then 'ADMITTED' else
            {choose('o_orderkey', ['HOME', 'Home', 'home', 'LEFT AGAINST MEDICAL ADVICE', 'EXPIRED', 'Transfer'])} end as disposition,
          case when o_orderkey % 79 = 6 then '93 mg' else {text('50 + o_orderkey % 90')} end as heartrate,
          case when o_orderkey % 71 = 0 then '9' when o_orderkey % 73 = 0 then null else {text('1 + o_orderkey % 5')} end as acuity,
          case when o_orderkey % 67 = 2 then {d.clinical('o_orderdate', 'minute - 5')} else {d.clinical('o_orderdate', 'minute + o_orderkey % 40')} end as triage_time,
          {d.clinical('o_orderdate', 'minute + 10 + o_orderkey * 3 % 90')} as provider_seen_time,
          case when o_orderpriority = '2-HIGH' then {d.clinical('o_orderdate', 'minute + 50 + o_orderkey * 5 % 200')} end as admit_decision_time,
          case when o_orderkey % 103 = 9 then 'F000' else {facility} end as facility_id, {system} as source_system,
          {d.day('o_orderdate', add='b', form='compact')} as _batch_id
        from (select *, {d.twice('o_orderkey % 20 = 4')} as b from {o}) v
        where o_orderpriority in ('2-HIGH', '3-MEDIUM', '5-LOW')"""
    missed = "o_orderkey % 8 = 3"
    out["outpatient_visits"] = f"""
        select 'VIS' || {padded('o_orderkey', 9)} as visit_id, {enc} as encounter_id, {patient} as subject_id, {facility} as facility_id,
          {unit} as unit_id, {choose('o_orderkey', ['OPC', 'ASC'])} as clinic_type, {d.clinical('o_orderdate', 'minute')} as appointment_time,
          case when {missed} then null else {d.clinical('o_orderdate', 'minute - 15 + o_orderkey * 3 % 40')} end as arrival_time,
          case when {missed} then null else {d.clinical('o_orderdate', 'minute + 26 + o_orderkey * 7 % 70')} end as provider_seen_time,
          {d.clinical('o_orderdate', 'minute + 200')} as departure_time, case when {missed} then null else {staff} end as seen_by_provider_id,
          case when {missed} then {choose('o_custkey', ['no show', 'NO SHOW'])} when o_orderkey % 97 = 1 then 'ZZZ'
            else {choose('o_custkey', ['completed', 'Completed', 'admitted '])} end as visit_status,
          case when {missed} then '1' else '0' end as is_no_show, case when o_orderkey % 30 = 7 then '1' else '0' end as escalated_to_inpatient,
          case when o_orderkey % 77 = 5 then 'X00' else {choose('o_orderkey', ICD)} end as primary_diagnosis_code,
          {payer} as payer_id, {system} as source_system, {d.day('o_orderdate', form='compact')} as _batch_id
        from {o} where o_orderpriority = '4-NOT SPECIFIED'"""
    line_minute = "l_partkey * 11 % 1440"
    out["transfers"] = f"""
        select {patient} as subject_id, {hadm} as hadm_id, 'TRF' || {text('l_orderkey')} || '-' || {text('l_linenumber')} as transfer_id,
          case when l_linenumber = 1 then 'admit' else 'transfer' end as eventtype, {unit_code} as careunit,
          {d.stamp('l_shipdate', line_minute)} as intime,
          {d.stamp('l_shipdate', f'case when l_partkey % 83 = 9 then {line_minute} - 30 else {line_minute} + 60 * l_quantity + l_partkey % 60 end')} as outtime,
          {facility} as facility_id, case when l_partkey % 67 = 2 then 'NO-UNIT' else {unit} end as unit_id,
          {d.day('l_shipdate', form='compact')} as _batch_id
        from {l} where {admitted}"""
    out["diagnoses"] = f"""
        select {patient} as subject_id, case when {admitted} then {hadm} end as hadm_id, {enc} as encounter_id,
          {text('l_linenumber')} as seq_num, {icd} as icd_code,
          case when l_partkey % 67 = 3 then '11' when l_partkey % 13 = 1 then '9' else '10' end as icd_version,
          'Title ' || {icd} as icd_title, {cohort} as hrrp_cohort, {facility} as facility_id, {d.day('l_shipdate', form='compact')} as _batch_id
        from {l}"""
    out["claim_header"] = f"""
        select {pcn} as patient_control_number, {enc} as encounter_id, case when {admitted} then {hadm} end as hadm_id,
          {patient} as subject_id, {facility} as facility_id,
          case when o_orderkey % 103 = 4 then {money('0 - o_totalprice')} when o_orderkey % 107 = 5 then '12.5 mg'
            when o_orderkey % 199 = 6 then {money('o_totalprice * 1000')} else {money('o_totalprice')} end as total_charge_amount,
          case when o_orderkey % 109 = 6 then 'PAY-ORPHAN' when o_orderkey % 139 = 1 then null else {payer} end as payer_id,
          {choose('o_orderkey', ['x', 'y', 'z'])} || ' ' || lower(c_mktsegment) as payer_name, '111' as type_of_bill,
          case when o_orderkey % 5 = 0 then null else '1' || {padded('case when o_orderkey % 149 = 3 then 777777 else s_suppkey - s_suppkey % 4 + 1 end', 9)} end as attending_provider_npi,
          case when o_orderkey % 6 = 1 then '1' else '0' end as is_readmission_related,
          {d.day('o_orderdate', add='o_orderkey % 20')} as submission_date, {choose('o_orderkey', ICD)} as principal_diagnosis,
          {choose('o_custkey', ICD)} || '|' || {choose('o_orderkey + 1', ICD)} as other_diagnoses,
          {padded('o_orderkey % 6 * 3 + o_orderkey % 3', 3)} as drg_code, {d.day('o_orderdate', form='compact')} as _batch_id
        from {o}"""
    out["claim_line"] = f"""
        select {pcn} as patient_control_number, {text('l_linenumber')} as line_control_number, {padded('l_partkey % 40', 4)} as revenue_code,
          {money('l_extendedprice')} as line_charge_amount, {text('l_quantity')} as unit_count, '0.00' as non_covered_amount,
          {d.day('l_shipdate')} as service_date_from, {d.day('l_shipdate', add='1')} as service_date_to,
          {d.day('l_shipdate', form='compact')} as _batch_id
        from {l}"""
    charge, paid = "cast(l_extendedprice as decimal(18,2))", "cast(l_extendedprice as decimal(18,2)) - 10 * cast(l_quantity as decimal(18,2))"
    out["remit"] = f"""
        select {pcn} as patient_control_number, case when l_partkey % 61 = 4 then null when l_returnflag = 'R' and l_partkey % 3 = 0 then '4' else '1' end as claim_status_code,
          {text(charge)} as total_claim_charge_amount,
          case when l_partkey % 211 = 7 then {text(f'6 * {charge}')} when l_returnflag = 'R' and l_partkey % 3 = 0 then '0.00' when l_partkey % 47 = 1 then null else {text(paid)} end as claim_payment_amount,
          '0.00' as patient_responsibility_amount, {d.day('o_orderdate', add='20 + l_partkey * 7 % 90 + l_linenumber')} as remit_date,
          case when l_partkey % 9 = 0 then '1' else '0' end as is_appealed, case when l_partkey % 18 = 0 then '1' else '0' end as is_overturned_on_appeal,
          {d.day('l_shipdate', form='compact')} as _batch_id
        from {l} where l_linestatus = 'F'"""
    reason = choose("l_partkey", ["45", "16", "50", "45", "97", "24", "1", "45", "18", "197"])
    out["remit_adjustment"] = f"""
        select patient_control_number, adjustment_seq, case when reason_code = '1' then 'PR' when reason_code = '18' then 'OA' else 'CO' end as group_code,
          reason_code, amount, case when reason_code = '16' and p % 97 <> 1 then 'MA130' end as remark_code,
          case when reason_code in ('16', '50', '18', '197') then '1' else '0' end as is_denial, _batch_id
        from (select {pcn} as patient_control_number, {text('l_linenumber')} as adjustment_seq, {reason} as reason_code,
                {money('l_quantity')} as amount, l_partkey as p, {d.day('l_shipdate', form='compact')} as _batch_id from {l}) v"""
    q = d.idiv("occupied * 10000", "staffed - blocked")
    out["bed_hourly"] = f"""
        select {d.iso('hr')} as snapshot_datetime, {facility} as facility_id, case when s_suppkey % 43 = 5 then 'NO-UNIT' else {unit} end as unit_id,
          {unit_code} as unit_code, {text('10 + s_suppkey % 40')} as licensed_beds, {text('staffed')} as staffed_beds, {text('blocked')} as blocked_beds,
          case when event_id % 211 = 6 then '-3' else {text('occupied')} end as occupied_beds,
          {text('case when staffed - blocked - occupied < 0 then 0 else staffed - blocked - occupied end')} as available_beds,
          {text('event_id % 5')} as pending_admissions, {text('event_id % 4')} as pending_discharges,
          {text(d.idiv(q, '10000'))} || '.' || lpad({text(f'{q} % 10000')}, 4, '0') as occupancy_rate,
          case when {q} >= 8500 then '1' else '0' end as is_at_capacity, {d.day('hr', form='compact')} as _batch_id
        from {e}"""
    out["bed_nhsn"] = f"""
        select {padded('n', 6)} as nhsn_org_id, case when n = 6 then 'Nowhere' else 'NATION_' || {text('n')} end as facility_name,
          {d.day('wk', add='6')} as week_ending_date, {d.day('wk', add='2')} as collection_date, {text('20 + n')} as all_hospital_inpatient_beds,
          case when n % 13 = 1 then {text('25 + n')} else {text('n % 10')} end as all_hospital_inpatient_occupancy,
          {d.day('wk', add='7', form='compact')} as _batch_id
        from (select distinct s_nationkey as n, date_trunc('week', ts) as wk from {e}) v"""
    out["pharmacy_inventory"] = f"""
        select {d.day('l_shipdate')} as snapshot_date, {d.stamp('l_shipdate', '135')} as counting_datetime, 'snapshot' as count_type,
          {facility} as facility_id, 'L' || {text('l_linenumber % 2')} as location_id,
          case when l_orderkey % 173 = 9 then null else {padded('l_partkey', 11)} end as ndc11, p_name as drug_name,
          case when l_orderkey % 97 = 3 then null when l_orderkey % 101 = 5 then {text('0 - l_quantity')} else {text('l_quantity - 1')} end as qty_on_hand,
          '0' as qty_on_order, {text('l_suppkey % 20')} as reorder_point, '50' as par_level, '5' as safety_stock,
          {text('l_partkey % 7')} as avg_daily_usage_30d,
          case when l_partkey % 7 > 0 then {text('l_linenumber + l_partkey % 7')} || '.5' end as days_on_hand,
          case when p_size % 7 = 0 then '1' else '0' end as is_controlled, case when p_size % 7 = 0 then 'CII' end as dea_schedule,
          case when l_partkey % 10 = 1 then 'Currently in Shortage' else 'Available' end as shortage_status, {money('p_retailprice')} as unit_cost,
          case when l_quantity = 1 then '1' else '0' end as is_stockout, {d.day('l_shipdate', form='compact')} as _batch_id
        from {l} join {t('part')} on p_partkey = l_partkey"""
    out["staff_schedules"] = f"""
        select {facility} as facility_id, {unit_code} as unit_code,
          case when l_orderkey % 157 = 3 then 'next week' when l_linenumber % 2 = 0 then {d.day('l_shipdate', form='us')} else {d.day('l_shipdate')} end as work_date,
          {choose('l_partkey', ['D', 'E', 'N', 'OC'])} as shift, {choose('l_partkey', ['07:00', '15:00', '23:00', '00:00'])} as shift_start,
          case when l_orderkey % 163 = 4 then 'STF-ORPHAN' else {staff} end as staff_id, {choose('l_orderkey', ['RN', 'LPN', 'NP', 'MD', 'RN'])} as job_code,
          '12' as scheduled_hours, case when l_partkey % 4 = 3 then null else {text('8 + l_linenumber')} end as actual_hours,
          case when l_quantity <= 5 then 'Y' end as called_out, {text('l_quantity % 9')} as census, {d.day('l_shipdate', form='compact')} as _batch_id
        from {l}"""
    out["icd10"] = f"""
        select icd as icd10_code, 'Title ' || icd as icd10_description, '10' as icd_version, substr(icd, 1, 1) as code_chapter,
          cohort as hrrp_cohort, '0' as is_chronic, 'low' as readmission_risk_level, {text('n')} as relative_frequency, '20240101' as _batch_id
        from (select {icd} as icd, {cohort} as cohort, count(*) as n from {t('lineitem')} group by 1, 2) v"""
    out["drg"] = f"""
        select {padded('f * 3 + r', 3)} as drg_code, 'DRG ' || {text('f * 3 + r')} as drg_description,
          {text('cast(0.5 + f * 0.2 + r * 0.25 as decimal(6,2))')} as relative_weight, {choose('r', ['NONE', 'CC', 'MCC'])} as severity_tier,
          {choose('f', ['SEPSIS', 'HF', 'COPD', 'PN', 'RENAL', 'OTHER_MEDICAL'])} as drg_family, 'MED' as drg_type, '20240101' as _batch_id
        from (select distinct p_partkey % 6 as f, p_size % 3 as r from {t('part')}) v"""
    return out


LOINC = ["8867-4", "8480-6", "8462-4", "9279-1", "8310-5", "2708-6"]


def event_feed(d: Dialect) -> str:
    """Monitor readings and prescriptions in one envelope stream, with repeats and late arrivals."""
    t = d.table
    return f"""
        select {text('event_id')} as event_id, case when event_type = 'purchase' then 'prescription.issued' else 'vitals.reading' end as event_type,
          ts as event_time, case when event_id % 50 = 3 then 900 else event_id % 9 + 1 end as lag_seconds, 'MONITOR' as source_system,
          {padded('user_id % 25', 6)} as facility_id, '1.0' as schema_version, 'ENC' || {padded('user_id', 9)} as encounter_id,
          'U' || {text('user_id % 40')} as unit_id, {choose('event_id', LOINC)} as loinc_code,
          case when event_id % 61 = 7 then null else case event_id % 6 when 4 then 33.0 + cast(floor(value) % 8 as double)
            when 5 then 85.0 + cast(floor(value) % 16 as double) else 5.0 + cast(floor(value) as double) end end as value_num,
          event_id % 41 = 5 as is_artifact
        from (select *, {d.twice('event_id % 33 = 2')} as b from {t('events')}) e"""


class Bronze:
    """Bronze frames by table name, derived from the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}
        self._frames: dict[str, DataFrame] = {}
        self._sql, self._joins = feeds(Dialect()), {}

    def share(self) -> None:
        """For callers that read many feeds: a join that several are made from is written when the first of them is asked for.

        Of its columns those are written that a feed names.
        """
        shared = Shared()
        self._sql, self._joins, self._frames = feeds(shared), shared.joins, {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            if name in self._joins:
                named = {word for sql in self._sql.values() for word in re.findall(r"\w+", sql)}
                rows = self.run(self._joins[name])
                self._read[name] = settle(rows.select(*[c for c in rows.columns if c in named]))
            else:
                self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def run(self, sql: str) -> DataFrame:
        used = {n: self.table(n) for n in [*TABLES, *self._joins] if "{" + n + "}" in sql}
        return self.spark.sql(sql.replace('"', "`"), **used)

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = conform(self.run(self._sql[name]), FEEDS[name])
        return self._frames[name]

    def events(self) -> DataFrame:
        return self.run(event_feed(Dialect()))
