"""Rows with only some of their columns: the same rows and values as the whole tables, from less work."""

import random

import pytest

from wardflow.operators.dedupe import latest_batch, latest_per_key
from wardflow.operators.quality import judge, required, within
from wardflow.plans.checks import CHECKED
from wardflow.plans.dashboards import FACILITY_NAME
from wardflow.plans.gold import Gold
from wardflow.plans.measures import Model
from wardflow.plans.silver import TABLES
from workload.oracle_tables import AS_OF
from workload.queries import Hospital

SMALL = "/root/testdata/sf0.001"


def _copies(spark):
    random.seed(5)
    values = [None, "a", "b"]
    return spark.createDataFrame([tuple(random.choice(values) for _ in range(6)) for _ in range(400)],
                                 "k string, l string, x string, y string, z string, _batch_id string")


@pytest.mark.parametrize("needed", [["x"], ["y"], ["k", "z"], ["_batch_id"], ["k"], ["y", "_batch_id"]])
def test_needed_columns_equal_those_of_the_whole_row(spark, rows, needed):
    df = _copies(spark)
    whole, narrow = latest_batch(df, ["k", "l"]), latest_batch(df, ["k", "l"], needed)
    columns = ["k", "l", *[c for c in needed if c not in ("k", "l")]]
    assert rows(narrow, *columns) == rows(whole, *columns) and whole.count() == 9
    assert rows(latest_per_key(df, ["k"], ["`y` DESC"], needed=needed), *needed) == rows(latest_per_key(df, ["k"], ["`y` DESC"]), *needed)


def test_later_ties_are_not_shuffled_and_keys_alone_are_not_sorted(spark):
    df = _copies(spark)
    assert latest_batch(df, ["k"], ["l", "y"]).columns == ["k", "l", "x", "y", "_batch_id"]
    plan = latest_batch(df, ["k", "l"], ["l"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


@pytest.mark.parametrize("name, columns", [("claim_line", ["patient_control_number"]), ("staff_schedules", ["shift", "census_int"]),
                                           ("claim_header", ["drg_code", "submission_date_d"]), ("bed_hourly", [])])
def test_verdicts_equal_those_of_the_whole_table(spark, rows, name, columns):
    columns = [*columns, "_dq_issues", "_dq_passed"]
    assert rows(Hospital(spark, SMALL)._silver.verdicts(name, columns[:-2]), *columns) == rows(Hospital(spark, SMALL).silver(name), *columns)


def test_verdicts_do_not_number_persons(spark):
    hospital = Hospital(spark, SMALL)
    assert hospital.verdicts("claim_line").count() > 0 and not hospital._silver._bases
    assert all(table.reads() is not None for table in TABLES.values())


@pytest.mark.parametrize("name, columns", [
    ("fact_claims", ["amount_at_risk", "payer_key", "is_paid"]), ("fact_claims", ["remit_date", "is_appealed", "attending_staff_key"]),
    ("fact_staffing", ["unit_key", "staff_key", "work_date_key"]), ("fact_bed_capacity", ["licensed_beds", "staffed_beds", "occupancy_rate"]),
    ("fact_outpatient_visits", ["patient_key", "wait_time_minutes"])])
def test_columns_of_a_fact_equal_those_of_the_whole_fact(spark, rows, name, columns):
    assert rows(Hospital(spark, SMALL).fact(name, columns), *columns) == rows(Hospital(spark, SMALL).gold(name), *columns)


def test_measures_write_no_more_of_a_fact_than_they_read(spark):
    asked = {}

    def fact(name, columns):
        asked[name] = columns
        return spark.createDataFrame([], ", ".join(f"{c} {'boolean' if c.startswith('is_') else 'int'}" for c in columns))
    Model(lambda name: spark.createDataFrame([], "facility_key int, facility_name string"), fact).evaluate(
        ["Readmission Rate", "Total Revenue at Risk"], [FACILITY_NAME])
    assert asked == {"fact_admissions": ["is_readmission", "facility_key", "hadm_id"], "fact_claims": ["amount_at_risk", "facility_key"]}


def test_a_payer_of_adjustments_needs_no_remittance(spark):
    hospital = Hospital(spark, SMALL)
    plan = hospital.fact("fact_claims", ["patient_control_number", "payer_key"])._jdf.queryExecution().optimizedPlan().toString()
    assert "claim_payment_amount" not in plan and not {"patients", "remit"} & set(hospital._silver._bases)


@pytest.mark.parametrize("name", ["pharmacy_inventory", "staff_schedules", "remit_adjustment"])
def test_checked_columns_equal_those_of_the_base(spark, rows, name):
    silver = Hospital(spark, SMALL)._silver
    narrow, wanted = silver.columns(name, CHECKED[name]), CHECKED[name]
    assert rows(narrow, *wanted) == rows(silver.base(name), *wanted)
    if name == "pharmacy_inventory":
        plan = narrow._jdf.queryExecution().optimizedPlan().toString()
        assert "is_stockout" not in plan, "a column after the last one needed is not carried"


def test_a_verdict_names_each_message_once_in_rule_order_without_an_array_per_row(spark):
    df = spark.sql("select * from values (1, 2), (5, null), (null, 9), (7, 9), (null, null) as t(a, b)")
    rules = [within("b", None, 8, "b large"), within("a", None, 4, "large"), required("a"), within("b", None, 5, "large"), required("b")]
    judged = judge(df, rules)
    assert [(r.a, r.b, r._dq_issues, r._dq_passed) for r in judged.collect()] == [
        (1, 2, "", True), (5, None, "large; b null", False), (None, 9, "b large; large; a null", False),
        (7, 9, "b large; large", False), (None, None, "a null; b null", False)]
    assert [(r._dq_issues, r._dq_passed) for r in judge(df.limit(1), []).collect()] == [("", True)]
    for plan in (judged, Hospital(spark, SMALL).silver("remit_adjustment")):
        said = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in said and "array_distinct" not in said


def test_claims_are_not_judged_once_more_for_their_remittances(spark, rows):
    hospital = Hospital(spark, SMALL)
    narrow = hospital.gold("fact_claims")
    assert not [parent for parent, _, gated in hospital._silver._known if parent == "claim_header" and gated]
    judged = Gold(spark, hospital._silver.table, as_of=AS_OF)
    judged.use(**{name: table for name, table in hospital._gold._tables.items() if name.startswith("dim_")})
    found = rows(narrow, *narrow.columns)
    assert found == rows(judged.table("fact_claims"), *narrow.columns) and any(r[narrow.columns.index("remit_date")] for r in found)
