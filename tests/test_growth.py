"""Steps whose cost must not outgrow their input."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wardflow.operators import audit, intervals
from wardflow.operators.quality import ForeignKey
from wardflow.plans import kpi_beds
from wardflow.plans.silver import Silver
from wardflow.session import once
from wardflow.sources.feeds import FEEDS


def _stays(spark):
    random.seed(3)
    start = dt.datetime(2024, 1, 1)
    data = []
    for _ in range(60):
        a = start + dt.timedelta(minutes=random.randint(0, 6000))
        b = a + dt.timedelta(minutes=random.randint(-60, 3000))
        data.append((f"U{random.randint(0, 4)}", random.choice([a, a, a, None]), random.choice([b, b, b, None])))
    return spark.createDataFrame(data, "unit_id string, intime_ts timestamp, outtime_ts timestamp")


def test_bed_totals_equal_summed_snapshots(spark, rows):
    stays = _stays(spark)
    units = spark.createDataFrame([("U0", "f", "a", 9, 4, 1), ("U1", "f", "b", 9, 3, 3), ("U2", "g", "c", 9, 2, 0), ("U3", "g", "d", 9, None, 1)],
                                  "unit_id string, facility_id string, unit_code string, licensed_beds int, staffed_beds int, blocked_beds int")
    summed = kpi_beds.bed_snapshots(stays, units).groupBy("snapshot_datetime").agg(
        F.count_distinct("unit_id").alias("units"), F.sum("occupied_beds").alias("occupied_beds"),
        F.sum("pending_discharges").alias("pending_discharges"), F.sum("available_beds").alias("available_beds"),
        F.count_if("is_at_capacity").alias("units_at_capacity"))
    totals = kpi_beds.bed_totals(stays, units)
    names = ["snapshot_datetime", "units", "occupied_beds", "pending_discharges", "available_beds", "units_at_capacity"]
    assert rows(totals, *names) == rows(summed, *names) and totals.count() > 100


def test_counts_are_shuffled_per_change_and_not_per_instant(spark):
    spans = {"n": intervals.presence("intime_ts", "outtime_ts", "hour")}
    counts = intervals.counts_over_time(_stays(spark), ["unit_id"], spans, "hour")
    plan = counts._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    assert "Join" not in plan, plan


def test_parent_keys_are_computed_once_and_without_choosing_rows(spark):
    made = []

    def bronze(name):
        made.append(name)
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*FEEDS[name].columns, "_batch_id"]))
    silver = Silver(bronze)
    for name in ("claim_line", "remit_adjustment", "remit"):
        assert silver.table(name).count() == 0
    assert made.count("claim_header") == 1 and len(silver._known) == len(set(silver._known))
    plan = silver.known(ForeignKey("facility_id", "facility", "facility_id", ""))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_dimensions_and_facts_are_settled_once(spark):
    made = []

    def tables(name):
        made.append(name)
        return spark.range(3)
    supplied = once(tables, "fact_")
    assert supplied("fact_a") is supplied("fact_a") and made == ["fact_a"]
    assert "parquet" in supplied("fact_a")._jdf.queryExecution().executedPlan().toString().lower()
    assert supplied("dim_a") is not supplied("dim_a")


def test_orphans_are_counted_in_one_grouping(spark, rows):
    child = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), (None, "z"), ("c", "z")], "k string, l string")
    other = spark.createDataFrame([("a",), ("q",), ("q",)], "k string")
    parent = spark.createDataFrame([("a", "x"), ("b", None), (None, "z")], "id string, code string")
    relations = [audit.Relation("c", "k", "p", "id"), audit.Relation("c", "l", "p", "code", 0.2), audit.Relation("o", "k", "p", "id")]
    out = audit.orphan_matrix(relations, {"c": child, "o": other, "p": parent})
    assert rows(out) == [("c.k -> p.id", 5, 1, 0.0, "WARN"), ("c.l -> p.code", 5, 1, 0.2, "PASS"), ("o.k -> p.id", 3, 1, 0.0, "WARN")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1, "only the list of relations is joined"
