"""Verdicts that are only counted, and feeds that share a join: the same figures from less work."""

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from wardflow.functions.parsing import to_day
from wardflow.operators.audit import issue_breakdown, run_summary
from wardflow.operators.quality import ISSUES, PASSED, ForeignKey, judge, required, resolve_keys, tally, within
from workload import queries
from workload.derive import Bronze, Dialect


def _visits(spark):
    data = [("a", "p1", "u1", 3), ("a", "p1", "u1", 3), ("b", "p9", None, 12), (None, "p1", "u7", None), ("a", None, "u1", 12), ("q", "p9", "u7", -4),
            *[("b", "p2", "u1", i) for i in range(6)]]
    return spark.createDataFrame(data, "k string, p string, u string, n int")


def _checks():
    return [required("k"), within("n", 0, 9, "n out of range"), ForeignKey("u", "unit", "id", "no unit"),
            ForeignKey("p", "person", "id", "no person", null_fails=True, large=True), within("n", None, 4, "n large"),
            ForeignKey("k", "key", "id", "n large", large=True)]


def _parents(spark):
    tables = {"unit": ["u1", None], "person": ["p1", "p2"], "key": ["a", "b", "b"]}
    frames = {n: spark.createDataFrame([(v,) for v in values], "id string") for n, values in tables.items()}
    return lambda item: frames[item.parent].filter("id IS NOT NULL").distinct()


def test_counted_verdicts_equal_judged_rows(spark, rows):
    known, visits = _parents(spark), _visits(spark)
    for checks in (_checks(), _checks()[:3], _checks()[:2], [*_checks()[2:4], ForeignKey("p", "key", "id", "p no key", large=True)]):
        judged = judge(*resolve_keys(visits, checks, lambda name, gated: None, known))
        counts = tally(visits, checks, known)
        assert rows(counts, ISSUES, PASSED, "rows") == rows(judged.groupBy(ISSUES, PASSED).agg(F.count(F.lit(1)).alias("rows")), ISSUES, PASSED, "rows")
        names = ["table_name", "rows_total", "rows_passed", "rows_failed"]
        assert rows(run_summary(counts, "t", rows="rows"), *names) == rows(run_summary(judged, "t"), *names)
        assert rows(issue_breakdown(counts, "rows")) == rows(issue_breakdown(judged))
    none = tally(visits.filter("false"), _checks(), known)
    assert rows(run_summary(none, "t", rows="rows"), "rows_total", "rows_passed", "rows_failed") == [(0, 0, 0)]


def test_rows_are_counted_before_their_last_large_key_is_looked_up(spark):
    plan = tally(_visits(spark), _checks()[:4], _parents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate", plan.index("Join")) < plan.rindex("Join"), plan


def _stub(spark, monkeypatch):
    shared = []

    class Hospital:
        def __init__(self, session, folder):
            self.spark, self.bronze = session, SimpleNamespace(share=lambda: shared.append(folder))

        def counts(self, name):
            return spark.createDataFrame([("a; b", False, 2), ("b", False, 5), ("", True, 3)], f"{ISSUES} string, {PASSED} boolean, rows long")

        def fact(self, name, keys):
            return spark.createDataFrame([tuple(None for _ in keys), tuple("x" for _ in keys)], ", ".join(f"{k} string" for k in keys))
    monkeypatch.setattr(queries, "Hospital", Hospital)
    return shared


def test_audits_of_all_tables_are_written_table_after_table(spark, rows, monkeypatch):
    import workload.kpi_queries as kpi
    shared = _stub(spark, monkeypatch)
    found = {name: queries.QUERIES[name](spark, "x") for name in ("dq_run_log", "dq_issue_breakdown", "dq_null_keys")}
    for df in found.values():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "Relation" in plan, plan
    assert shared == ["x"] * 3, "feeds share their joins"
    want = sorted((f"silver_{n}", issue, count) for n in kpi.LOGGED for issue, count in (("a", 2), ("b", 7)))
    assert sorted(rows(found["dq_issue_breakdown"], "table_name", "issue", "rows")) == want
    assert sorted(rows(found["dq_run_log"], "table_name", "rows_total", "rows_passed", "rows_failed")) == sorted((f"silver_{n}", 10, 3, 7) for n in kpi.LOGGED)
    assert all(r["null_rows"] == 1 and r["rows"] == 2 for r in found["dq_null_keys"].collect())


def _tables(spark, folder):
    day = dt.datetime(1995, 3, 4)
    tables = {
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "NATION_0", 0), (1, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(0, "c", 0, -1.5, "BUILDING"), (1, "d", 1, 2.0, None), (1, "d", 1, 2.0, None)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(0, "s", 0, 1.0), (1, "t", 1, None), (None, "u", 1, None)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(0, "p", "B", "T", 7, 1.5), (1, None, "B", None, None, 2.5)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(i, i % 3, "O", 10.5 * i, day + dt.timedelta(days=i) if i % 4 else None, p) for i, p in enumerate(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None, "2-HIGH"])],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i % 8, i % 3, i % 2 if i % 5 else None, i % 2, 1.0 * i, 5.25 * i, 0.1, 0.2, "R", "F", day + dt.timedelta(days=30 * i) if i % 6 else None) for i in [*range(20), 3, 3]],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ([(i, day + dt.timedelta(hours=i), i % 4, "view", 1.0, "{}") for i in range(9)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")


def test_feeds_that_share_their_joins_have_the_same_rows(spark, rows, tmp_path):
    _tables(spark, tmp_path)
    alone, shared = Bronze(spark, str(tmp_path)), Bronze(spark, str(tmp_path))
    shared.share()
    for name in shared._sql:
        assert shared(name).columns == alone(name).columns and rows(shared(name)) == rows(alone(name)), name
    assert shared("diagnoses").count() > 10 and shared("encounters").count() > 4
    plan = shared("claim_line")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and set(shared._joins) == {"joined_l", "joined_o"}


def test_days_written_as_digits_equal_formatted_ones(spark):
    df = spark.sql("select cast(d as date) as d from values ('1992-01-01'), ('2024-02-29'), ('0999-12-31'), ('0001-03-04'), ('9999-12-31'), ('9999-12-30'), (null) as t(d)")
    found = df.selectExpr(f"{Dialect().day('d', form='compact')} as a", "date_format(d, 'yyyyMMdd') as b").collect()
    assert [r.a for r in found] == [r.b for r in found] and found[1].a == "20240229"


def test_formats_are_tried_on_texts_that_have_their_separators(spark):
    texts = ["2026-08-05", "08/05/2026", "next week", "", None, "2026-13-05", "13/13/2026", "2026-08-05 10:00", "2026-8-5", "08-05/2026", "+2026-08-05", " 2026-08-05"]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    formats = ["yyyy-MM-dd", "MM/dd/yyyy"]
    plain = F.coalesce(*[F.try_to_timestamp("a", F.lit(f)).cast("date") for f in formats])
    out = df.select(plain.alias("plain"), to_day("a", *formats).alias("found"))
    assert [r.plain for r in out.collect()] == [r.found for r in out.collect()]
    assert "contains" in df.select(to_day("a", *formats))._jdf.queryExecution().optimizedPlan().toString().lower()
