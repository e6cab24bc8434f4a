import datetime as dt
import os
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.operators import aggregates, dedupe, intervals, joins, neighbours, ordered, percentiles, quality, scd


def test_latest_per_key_is_total_and_reproducible(spark, rows):
    data = [("a", "20240101", "x"), ("a", "20240102", "b"), ("a", "20240102", "c"), (None, "1", "p"), (None, "2", "q")]
    df = spark.createDataFrame(data, "k string, _batch_id string, v string")
    assert rows(dedupe.latest_batch(df, ["k"])) == [("a", "20240102", "c"), (None, "2", "q")]
    kept = dedupe.latest_per_key(df.repartition(3), ["k"], ["_batch_id DESC"], keep_null_keys=True)
    assert rows(kept) == [("a", "20240102", "c"), (None, "1", "p"), (None, "2", "q")]


def test_latest_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedupe.latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange"), "one of them sits below the exchange"


def test_dense_number_equals_row_number(spark, rows, monkeypatch):
    monkeypatch.setattr(ordered, "RANGES", 7)
    monkeypatch.setattr(ordered, "SAMPLE", 40)
    random.seed(1)
    words = sorted({"".join(random.choices("abc|:é", k=random.randint(0, 6))) for _ in range(400)})
    df = spark.createDataFrame([(w,) for w in random.sample(words, len(words))], "w string").repartition(5)
    got = dict(rows(ordered.dense_number(df, ["w"], "n")))
    order = sorted(words, key=lambda w: w.encode())
    assert got == {w: i + 1 for i, w in enumerate(order)}
    stepped = ordered.dense_number(spark.range(5, 500, 3), ["id"], "n", running=True)
    assert rows(stepped) == sorted([(i, n + 1) for n, i in enumerate(range(5, 500, 3))], key=lambda r: [(False, str(v)) for v in r])


@pytest.mark.parametrize("ranges", [1, 7, 1000])
def test_numbers_do_not_depend_on_the_ranges(spark, rows, monkeypatch, ranges):
    monkeypatch.setattr(ordered, "RANGES", ranges)
    monkeypatch.setattr(ordered, "SAMPLE", 4 * ranges)
    df = spark.range(3000).selectExpr("pmod(xxhash64(id), 1000003) AS k", "id").repartition(5)
    want = sorted((r.k, r.id) for r in df.collect())
    got = ordered.dense_number(df, ["k", "id"], "n").collect()
    assert {(r.k, r.id): r.n for r in got} == {key: n for n, key in enumerate(want, 1)}


def test_ranges_grow_with_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGES", 2)
    monkeypatch.setattr(ordered, "SAMPLE", 64)
    monkeypatch.setattr(ordered, "SPAN", 100)
    for rows, least in [(100, 2), (1000, 8), (5000, 40)]:
        found = ordered._with_range(spark.range(rows), ["id"]).groupBy("_range").count().collect()
        assert least <= len(found) <= 2 * least + 20 and max(r["count"] for r in found) <= max(rows / 2 + 10, 400)


def test_dense_number_of_nothing(spark):
    assert ordered.dense_number(spark.createDataFrame([], "w string"), ["w"], "n").count() == 0


def test_running_total_and_abc(spark, rows, monkeypatch):
    monkeypatch.setattr(ordered, "RANGES", 4)
    monkeypatch.setattr(ordered, "SAMPLE", 16)
    random.seed(2)
    data = [(i, random.choice([1, 2, 5, 5, 100])) for i in range(200)]
    df = spark.createDataFrame(data, "k int, v int").withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = {k: (float(c), a) for k, _, c, _, a in rows(ordered.abc_classes(df, "k", "v"))}
    total, run = sum(v for _, v in data), 0
    for k, v in sorted(data, key=lambda r: (-r[1], -r[0])):
        run += v
        assert got[k] == (run, "A" if run / total <= 0.8 else "B" if run / total <= 0.95 else "C")


def test_abc_when_nothing_has_value(spark):
    df = spark.createDataFrame([(1, 0)], "k int, v int").withColumn("v", F.col("v").cast("decimal(18,2)"))
    assert ordered.abc_classes(df, "k", "v").first()["abc_class"] == "C"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50), st.floats(-1e9, 1e9))), max_size=60))
def test_percentiles_equal_numpy(spark, data):
    df = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in data], "k string, v double")
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r["k"]: r for r in percentiles.exact_percentiles(df, ["k"], "v", wanted).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(float(v))
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, q in wanted.items():
            assert got[k][name] == pytest.approx(np.percentile(values, q * 100), rel=1e-12, abs=1e-9)


def _brute_neighbours(data, forward):
    out = {}
    for k in {r[0] for r in data}:
        group = sorted(r for r in data if r[0] == k)
        for i, r in enumerate(group):
            j = i + (1 if forward else -1)
            out[r[2]] = group[j][2] if k is not None and 0 <= j < len(group) else None
    return out


@pytest.mark.parametrize("forward", [True, False])
def test_neighbour_with_a_hot_key(spark, rows, forward):
    random.seed(3)
    start = dt.date(2024, 1, 1)
    data = [("hot" if random.random() < 0.5 else random.choice(["x", "y", "z"]), start + dt.timedelta(days=random.randint(0, 400)), i)
            for i in range(400)]
    df = spark.createDataFrame(data, "k string, d date, i int")
    out = neighbours.neighbour(df, ["k"], ["d", "i"], {"near": "i"}, F.date_trunc("month", "d"), forward)
    assert dict(rows(out, "i", "near")) == _brute_neighbours(data, forward)


def test_neighbour_ignores_null_keys(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", None), ("a", 3)], "k string, o int")
    out = neighbours.neighbour(df, ["k"], ["o"], {"near": "o"}, F.col("o"))
    assert all(r[-1] is None for r in rows(out))


def test_sequence_in_group(spark, rows):
    random.seed(4)
    data = [(random.choice("ab"), random.randint(0, 30), i) for i in range(200)]
    out = neighbours.sequence_in_group(spark.createDataFrame(data, "k string, o int, i int"), ["k"], ["o", "i"], F.floor(F.col("o") / 7), "n")
    want = {}
    for k in "ab":
        for n, r in enumerate(sorted(r for r in data if r[0] == k)):
            want[r[2]] = n + 1
    assert dict(rows(out, "i", "n")) == want


def test_scd_versions_compress_and_close(spark, rows):
    data = [("s1", "20240101", "RN"), ("s1", "20240108", "RN"), ("s1", "20240115", "MD"), ("s2", "20240101", "RN")]
    df = spark.createDataFrame(data, "id string, _batch_id string, job string")
    pick = ("id", "valid_from", "valid_to", "is_current")
    assert rows(scd.versions(df, "id"), *pick) == [
        ("s1", "20240101", "20240108", False), ("s1", "20240108", "20240115", False), ("s1", "20240115", None, True), ("s2", "20240101", None, True)]
    short = scd.versions(df, "id", compress=True, close_missing=True, attributes=["job"])
    assert rows(short, *pick) == [("s1", "20240101", "20240115", False), ("s1", "20240115", None, True), ("s2", "20240101", "20240101", False)]
    facts = spark.createDataFrame([("s1", "20240110"), ("s1", "20230101"), ("s9", "20240110")], "id string, at string")
    found = scd.as_of(facts, scd.versions(df, "id"), "id", "at", ["job"])
    assert rows(found, "id", "at", "job") == [("s1", "20230101", None), ("s1", "20240110", "RN"), ("s9", "20240110", None)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_key_join_equals_plain_join(spark, rows, how):
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 40) END AS k", "id")
    right = spark.range(30).selectExpr("concat('k', id) AS k", "id * 2 AS v").unionByName(spark.sql("SELECT 'hot' AS k, 7L AS v"))
    hot = joins.hot_keys(left, "k")
    assert hot[0] == "hot" and hot[-1] is None
    assert rows(joins.hot_key_join(left, right, "k", hot, how)) == rows(left.join(right, "k", how))
    assert rows(joins.hot_key_join(left, right, "k", ["k5", "hot"], how)) == rows(left.join(right, "k", how))


def test_hot_keys_of_nothing(spark):
    assert joins.hot_keys(spark.createDataFrame([], "k string"), "k") == []
    assert joins.hot_keys(spark.createDataFrame([("a",)], "k string"), "k") == []


def test_longest_prefix(spark, rows):
    df = spark.createDataFrame([("E11.22",), ("E11.9",), ("E1",), (None,), ("",), ("I50.23",)], "c string")
    out = joins.longest_prefix(df, "c", {"E11": "d", "E11.22": "r", "I50": "h"}, "f", "none")
    assert rows(out) == [("", "none"), ("E1", "none"), ("E11.22", "r"), ("E11.9", "d"), ("I50.23", "h"), (None, "none")]


def test_group_join_lets_null_groups_meet(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    right = spark.createDataFrame([(None, 5), ("b", 6)], "k string, m int")
    assert rows(aggregates.both_sides(left, right, ["k"])) == [("a", 1, 0), ("b", 0, 6), (None, 2, 5)]


def _stays(seed, n=60):
    random.seed(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        s = base + dt.timedelta(minutes=random.randint(0, 4000), seconds=random.choice([0, 0, 17]))
        e = None if random.random() < 0.1 else s + dt.timedelta(minutes=random.randint(-30, 900))
        out.append((random.choice(["u1", "u2"]), s, e))
    return out


def test_counts_over_time_equal_brute_force(spark, rows):
    data = _stays(5)
    df = spark.createDataFrame(data, "u string, s timestamp, e timestamp")
    spans = {"present": intervals.presence("s", "e", "hour"), "leaving": intervals.within_next("e", 4, "hour")}
    got = rows(intervals.counts_over_time(df, ["u"], spans, "hour"))
    assert len(got) > 100
    for u, at, present, leaving in got:
        here = [r for r in data if r[0] == u]
        assert present == sum(1 for _, s, e in here if s <= at and (e is None or at < e)), (u, at)
        assert leaving == sum(1 for _, s, e in here if e is not None and at <= e <= at + dt.timedelta(hours=4)), (u, at)


def test_clip_to_days(spark, rows):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 22), dt.datetime(2024, 1, 3))], "s timestamp, e timestamp")
    got = rows(intervals.clip_to_days(df, "s", "e"), "clip_start", "clip_end")
    assert got == [(dt.datetime(2024, 1, 1, 22), dt.datetime(2024, 1, 2)), (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))]


def test_rules_and_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (None, "b", 9), (3, None, None)], "id int, c string, n int")
    rules = [quality.required("id"), quality.in_domain("c", ["a"], "bad c"), quality.within("n", 0, 8, "n range"),
             quality.rule("bad c", lambda: F.col("c") == "b")]
    judged = quality.judge(df, rules)
    assert rows(judged, "_dq_issues", "_dq_passed") == [("", True), ("", True), ("id null; bad c; n range", False)]
    more = quality.add_issue(judged, F.col("n").isNull(), "no n")
    assert rows(more, "_dq_issues") == [("",), ("id null; bad c; n range",), ("no n",)]
    assert quality.gate(judged).count() == 2
    clean, bad = quality.quarantine(df, F.col("n") > 6)
    assert (clean.count(), bad.count()) == (2, 1)


def test_distinct_with_blank_counts_null_once(spark):
    df = spark.createDataFrame([(1, True), (1, True), (None, True), (None, True), (2, False)], "k int, ok boolean")
    row = df.agg(aggregates.distinct_with_blank(F.col("k")).alias("a"), aggregates.distinct_with_blank(F.col("k"), F.col("ok")).alias("b")).first()
    assert (row["a"], row["b"]) == (3, 2)


def test_sequence_numbers_keep_null_keys_and_null_order(spark):
    from wardflow.operators.neighbours import sequence_in_group
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 2), (None, 2, 3), (None, 9, 4), ("a", None, 5)], "k string, at int, id int")
    got = {r.id: r.n for r in sequence_in_group(df, ["k"], ["at", "id"], F.floor(F.col("at") / 2), "n").collect()}
    assert got == {5: 1, 2: 2, 1: 3, 3: 1, 4: 2}


def test_percentiles_skip_nan_and_order_infinities(spark):
    from wardflow.operators.percentiles import exact_percentiles
    df = spark.createDataFrame([("g", v) for v in (1.0, 2.0, float("nan"), float("inf"), None, float("-inf"), 3.0)], "g string, v double")
    row = exact_percentiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert (row["low"], row["mid"], row["high"]) == (float("-inf"), 2.0, float("inf"))


def test_current_row_does_not_depend_on_layout(spark):
    from wardflow.operators.scd import current
    rows = [("n", "20250101", "b", True), ("n", "20250201", "a", True), ("m", "20250101", "c", False)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "npi string, valid_from string, staff string, is_current boolean").repartition(3)
        assert [r.staff for r in current(df, "npi").collect()] == ["a"]


def test_shared_folder_must_be_named_off_a_local_master():
    from types import SimpleNamespace
    import pytest
    from wardflow.session import shared_folder
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(ValueError):
        shared_folder(SimpleNamespace(sparkContext=context))


def _bytes_under(folder):
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder) for name in names)


def test_settled_tables_are_discarded(spark):
    """A discarded table's files go; what was made from it before stays."""
    from wardflow.session import discard, settle, shared_folder
    folder = shared_folder(spark).removeprefix("file:")
    start = _bytes_under(folder)
    first = settle(spark.range(200_000).selectExpr("id", "sha2(cast(id as string), 256) AS text"))
    second = settle(first.groupBy("id").count())
    held = _bytes_under(folder)
    discard(first)
    discard(first)  # nothing more happens
    assert held - start > 8_000_000 and _bytes_under(folder) < held - 8_000_000
    assert second.count() == 200_000


def test_percentiles_of_values_that_lie_close(spark, monkeypatch):
    """All values of a group within 1 % of each other: histograms narrow the bands until each is short."""
    monkeypatch.setattr(percentiles, "SHORT", 200)
    rng = np.random.default_rng(5)
    close = 1.7e9 + rng.integers(0, 2_000_000, 20_000) / 7
    tiny = np.concatenate([rng.random(3000) * 1e-200, rng.random(3000) * 1e-3, -rng.random(3000) * 1e-3, [0.0, -0.0]])
    far = [float("inf")] * 5 + [float("-inf")] * 6 + [1.0, 1.5, float("nan")]
    rows = [("close", float(v)) for v in close] + [("tiny", float(v)) for v in tiny] + [("far", v) for v in far] + [(None, None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    wanted = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p999": 0.999, "p100": 1.0}
    got = {r["k"]: r for r in percentiles.exact_percentiles(df, ["k"], "v", wanted).collect()}
    assert set(got) == {"close", "tiny", "far"}
    for name, values in (("close", close), ("tiny", tiny)):
        for column, q in wanted.items():
            assert got[name][column] == pytest.approx(float(np.quantile(values, q)), rel=1e-15, abs=1e-300)
    assert (got["far"]["p0"], got["far"]["p50"], got["far"]["p100"]) == (float("-inf"), 1.0, float("inf"))
