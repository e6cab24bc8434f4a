"""KPIs, measures and audits on hand-made frames with known answers."""

import datetime as dt

from pyspark.sql import functions as F

from wardflow.operators import audit
from wardflow.plans import findings, kpi_beds, kpi_casemix, kpi_claims, kpi_readmissions, kpi_staffing
from wardflow.plans.measures import Model
from wardflow.plans.star import Attribute, Slice, path


def ts(day, hour=0):
    return dt.datetime(2026, 1, 1, hour) + dt.timedelta(days=day - 1)


def admissions(spark, entries):
    columns = ("encounter_id string, hadm_id string, dischtime_ts timestamp, hospital_expire_flag_bool boolean, discharge_location string, "
               "hospital_service string, is_readmission_bool boolean, is_planned_readmission_bool boolean, index_encounter_id string, facility_id string")
    return spark.createDataFrame(entries, columns)


def test_hrrp_golden(spark):
    stay = lambda e, day, **o: (e, f"H{e}", ts(day), o.get("died", False), o.get("to"), o.get("service"), "index" in o, o.get("planned"), o.get("index"), "F1")
    adm = admissions(spark, [
        stay("A", 1), stay("B", 2), stay("C", 3, died=True), stay("D", 4, to="AGAINST ADVICE"), stay("E", 5, service="PSYCH"),
        stay("R1", 20, index="A"),            # counts: index A is eligible
        stay("R2", 21, index="B", planned=True),   # planned: not counted
        stay("R3", 22, index="C"),            # index died: not linked
        stay("R4", 23, index="Z"),            # index outside the extract
        stay("LAST", 60),                     # closes the window: stays after day 30 are censored
    ])
    row = kpi_readmissions.hrrp(adm, min_index=3).first()
    # eligible: A, B and the readmissions R1-R4, all discharged by day 30
    assert (row["index_admissions"], row["unplanned_readmissions"], row["linked_readmissions"]) == (6, 3, 1)
    assert row["rate"] == 1 / 6
    assert kpi_readmissions.hrrp(adm, min_index=30).first()["rate"] is None
    dx = spark.createDataFrame([("HA", 1, "HF"), ("HB", 1, "PN"), ("HR1", 1, "OTHER")], "hadm_id string, seq_num_int int, hrrp_cohort string")
    by = {r["hrrp_cohort"]: (r["index_admissions"], r["readmissions"]) for r in kpi_readmissions.hrrp_by_cohort(adm, dx).collect()}
    assert by == {"HF": (1, 1), "PN": (1, 0), "OTHER": (1, 0)}, "a return belongs to the cohort of the stay it followed"


def test_occupancy_quarantine_and_zero_beds(spark):
    beds = spark.createDataFrame([("f", "u", 10, 0, 9, 0.9), ("f", "u", 10, 0, 5, 0.5), ("f", "u", 10, 0, 30, 3.0), ("f", "z", 2, 2, 0, None)],
                                 "facility_id string, unit_code string, staffed_beds_int int, blocked_beds_int int, occupied_beds_int int, occupancy_rate_float double")
    row = kpi_beds.occupancy(beds).first()
    assert (row["rows"], row["quarantined"], row["mean_occupancy"], row["share_at_capacity"]) == (3, 1, 0.7, 0.5)
    clean, bad = kpi_beds.split_impossible(beds)
    assert (clean.count(), bad.count()) == (2, 1)
    assert kpi_beds.zero_bed_rows(beds).first().asDict() == {"zero_bed_rows": 1, "wrongly_rated": 0}


def test_understaffing(spark):
    units = spark.createDataFrame([("MICU", 2.0)], "unit_code string, nurse_patient_ratio_target_float double")
    day = dt.date(2026, 1, 1)
    roster = spark.createDataFrame([
        ("f", "MICU", day, "D", "s1", "RN", None, 5), ("f", "MICU", day, "D", "s2", "RN", "Y", 5), ("f", "MICU", day, "D", "s3", "MD", None, 5),
        ("f", "MICU", day, "N", "s4", "RN", None, 2), ("f", "MICU", day, "OC", "s5", "RN", None, 50), ("f", "XX", day, "D", "s6", "RN", None, 9)],
        "facility_id string, unit_code string, work_date_parsed date, shift string, staff_id string, job_code string, called_out string, census_int int")
    shifts = {(r["unit_code"], r["shift"]): (r["nurses_on"], r["required"], r["is_understaffed"]) for r in kpi_staffing.shift_staffing(roster, units).collect()}
    assert shifts == {("MICU", "D"): (1, 3, True), ("MICU", "N"): (1, 1, False), ("XX", "D"): (1, None, False)}
    assert kpi_staffing.understaffing(roster, units).first()["on_call_shifts"] == 1


def test_write_off_is_no_denial(spark):
    adj = spark.createDataFrame([("CO", "45", False), ("CO", "16", True), ("OA", "18", True), ("PR", "1", False), ("OA", "23", False)], "group_code string, reason_code string, is_denial_bool boolean")
    got = [r["c"] for r in adj.select(kpi_claims.adjustment_class().alias("c")).collect()]
    assert got == ["write_off", "denial", "denial", "patient_responsibility", "other"]


def test_severity_falls_back_to_the_nearest_tier(spark):
    drgs = spark.createDataFrame([("871", "SEPSIS", "MCC", 1.8), ("872", "SEPSIS", "NONE", 1.0)], "drg_code string, drg_family string, severity_tier string, relative_weight double")
    dx = spark.createDataFrame([("h1", 1, "A41.9"), ("h2", 1, "A41.9"), ("h3", 1, "A41.9")], "hadm_id string, seq_num_int int, icd_code string")
    stays = spark.createDataFrame([("h1", "f", 1.0, True, True), ("h2", "f", 9.0, False, None), ("h3", "f", 2.0, False, False)],
                                  "hadm_id string, facility_id string, los_days double, is_icu boolean, is_expired boolean")
    got = {r["hadm_id"]: (r["severity_tier"], r["relative_weight"]) for r in kpi_casemix.drg_assignments(stays, dx, drgs).collect()}
    assert got == {"h1": ("MCC", 1.8), "h2": ("CC", 1.8), "h3": ("NONE", 1.0)}


def star(spark):
    tables = {
        "dim_facility": spark.createDataFrame([(1, "North"), (2, "South")], "facility_key long, facility_name string"),
        "dim_unit": spark.createDataFrame([(1, "ICU", 10, 2.0), (2, "Ward", 20, 5.0)], "unit_key long, unit_name string, staffed_beds int, nurse_patient_ratio_target double"),
        "dim_payer": spark.createDataFrame([(1, "P")], "payer_key long, payer_name string"),
        "fact_bed_capacity": spark.createDataFrame([(1, 1, ts(1), 0.95), (1, 2, ts(2), 0.85), (2, 1, ts(2), 0.5)],
                                                   "facility_key long, unit_key long, snapshot_datetime_ts timestamp, occupancy_rate double"),
        "fact_staffing": spark.createDataFrame([(1, 1, 7, 20260102, 8.0, 4.0), (1, 1, None, 20260102, 8.0, None), (1, 2, 8, 20260101, 8.0, 8.0), (2, 1, 9, 20260102, 8.0, 8.0)],
                                               "facility_key long, unit_key long, staff_key long, work_date_key int, scheduled_hours double, actual_hours double"),
        "fact_pharmacy_inventory": spark.createDataFrame([(1, 5, 20260102, True), (1, None, 20260102, True), (2, 5, 20260101, True)],
                                                         "facility_key long, drug_key long, snapshot_date_key int, is_stockout boolean"),
        "fact_claims": spark.createDataFrame([("c1", 1, 1)], "patient_control_number string, facility_key long, payer_key long"),
        "fact_claim_adjustments": spark.createDataFrame([("c1", 5)], "patient_control_number string, amount int"),
    }
    return tables.__getitem__


def test_measures_filter_context(spark):
    model = Model(star(spark))
    unit, facility = Attribute("dim_unit", "unit_name"), Attribute("dim_facility", "facility_name")
    got = {r["unit_name"]: r for r in model.evaluate(["Current Occupancy", "Capacity Risk", "Actual Staff Count", "Expected Staff Needed", "Active Stockouts"], [unit]).collect()}
    # the latest snapshot is global: ICU is rated on the South row of day 2 alone
    assert (got["ICU"]["Current Occupancy"], got["Ward"]["Capacity Risk"]) == (0.5, "Watch")
    # two known staff plus the blank one; each unit counts once
    assert (got["ICU"]["Actual Staff Count"], got["ICU"]["Expected Staff Needed"], got["Ward"]["Expected Staff Needed"]) == (3, 5.0, 4.0)
    assert {r["Active Stockouts"] for r in got.values()} == {2}, "unrelated to units: the overall value repeats"
    sliced = model.evaluate(["Avg Occupancy Rate"], where=[Slice("dim_facility", "facility_name", ("South",))]).first()
    assert sliced["Avg Occupancy Rate"] == 0.5
    total = {(r["facility_name"], r["is_total"]): r for r in model.evaluate(["Staffing Coverage", "Expected Staff Needed"], [facility], total=True).collect()}
    assert total[("North", False)]["Staffing Coverage"] == 0.5
    assert total[(None, True)]["Staffing Coverage"] == 20 / 32
    assert total[(None, True)]["Expected Staff Needed"] == 9.0, "ICU is in two facilities but one unit"


def test_path_crosses_from_fact_to_fact():
    assert [step[0] for step in path("fact_claim_lines", "dim_payer")] == ["fact_claims", "dim_payer"]
    assert path("fact_pharmacy_inventory", "dim_unit") is None


def test_freshness_tells_empty_from_missing(spark, rows):
    expected = audit.expected_deliveries(spark, [audit.Cadence("daily"), audit.Cadence("weekly", 1)], "2026-01-05", "2026-01-07")
    delivered = spark.createDataFrame([("daily", "20260105", 10), ("daily", "20260106", 0), ("weekly", "20260105", 3)], "feed string, batch_id string, rows long")
    got = rows(audit.freshness(expected, delivered), "feed", "batch_id", "status")
    assert got == [("daily", "20260105", "ok"), ("daily", "20260106", "empty"), ("daily", "20260107", "missing"), ("weekly", "20260105", "ok")]


def test_due_from_first_to_last_batch_of_each_feed(spark, rows):
    delivered = spark.createDataFrame([("daily", "20260105", 10), ("daily", "20260107", 0), ("weekly", "20260104", 3), ("weekly", "20260113", 3),
                                       ("daily", "no day", 1), ("unknown", "20260105", 1)], "feed string, batch_id string, rows long")
    due = audit.due_deliveries([audit.Cadence("daily"), audit.Cadence("weekly", 1), audit.Cadence("never")], delivered)
    assert rows(due, "feed", "batch_id") == [("daily", "20260105"), ("daily", "20260106"), ("daily", "20260107"),
                                             ("weekly", "20260105"), ("weekly", "20260112")]


def test_every_feed_has_a_cadence():
    from wardflow.sources.feeds import FEEDS, cadences
    assert {c.feed for c in cadences()} == set(FEEDS) and len(FEEDS) == 22


def test_check_summary(spark, rows):
    results = spark.createDataFrame([("a", "PASS"), ("b", "PASS"), ("c", "WARN")], "check_name string, status string")
    assert rows(audit.check_summary(results), "status", "checks") == [("PASS", 2), ("WARN", 1)]


def test_truncated_batch(spark, rows):
    counts = [("f", f"2026010{i}", n) for i, n in enumerate([100, 101, 99, 100, 60, 100], 1)]
    got = rows(audit.volume_check(spark.createDataFrame(counts, "feed string, batch_id string, rows long")), "batch_id", "status")
    assert [b for b, s in got if s == "truncated"] == ["20260105"]


def test_defect_finder_scores_full_recall(spark):
    """Plant every row-level class, score findings against the key."""
    good = [(f"s{i}", "F1", "HOME", "80", "3", f"2026-01-{i:02d} 10:00:00", f"2026-01-{i:02d} 12:00:00") for i in range(1, 10)]
    planted = [("d1", "F1", "HOME", "80", None, "2026-01-01 10:00:00", "2026-01-01 12:00:00"), ("d2", "F1", "ZZZ", "80", "3", "2026-01-01 10:00:00", "2026-01-01 12:00:00"),
               ("d3", "F1", "home", "93 mg", "3", "2026-01-01 10:00:00", "2026-01-01 12:00:00"), ("d4", "F1", "Home", "80000", "3", "2026-01-01 10:00:00", "2026-01-01 12:00:00"),
               ("d5", "F1", "HOME", "80", "3", "2026-01-01 12:00:00", "2026-01-01 10:00:00"), ("d6", "F1-ORPHAN", "HOME", "80", "3", "2026-01-01 10:00:00", "2026-01-01 12:00:00"),
               good[0]]
    stays = spark.createDataFrame(good + planted, "stay_id string, facility_id string, disposition string, heartrate string, acuity string, intime string, outtime string")
    facility = spark.createDataFrame([("F1",)], "facility_id string")
    key = spark.createDataFrame([("ed_stays", t, k) for t, k in [
        ("null_required_field", "d1"), ("invalid_code_value", "d2"), ("type_nonconformance", "d3"), ("outlier_numeric", "d4"),
        ("temporal_inversion", "d5"), ("orphan_foreign_key", "d6"), ("duplicate_row", "s1")]], "source string, defect_type string, row_key string")
    found = findings.find_defects({"ed_stays": stays, "facility": facility}.__getitem__, findings.Expectation(
        "ed_stays", "stay_id", ["acuity"], {"disposition": ["home"]}, {"heartrate": (20, 250)}, [("intime", "outtime")], {"facility_id": ("facility", "facility_id")}))
    scores = audit.score_findings(found, key).collect()
    assert len(scores) == 7 and all(r["recall"] == 1.0 and r["precision"] == 1.0 for r in scores), scores


def test_checks_report_unknown(spark):
    one = spark.createDataFrame([(None,)], "v double")
    assert audit.band_check(one, "x", "v", 0, 1).first()["status"] == "WARN"
    assert audit.violations(one, "y", F.col("v").isNull()).first()["status"] == "FAIL"


def test_weekly_census_is_compared_after_quarantine(spark):
    """Six good hours of 4 in 10 beds, and an impossible hour (40 in 10) and one without beds that must not count."""
    from wardflow.plans.checks import census_reconciliation
    beds = spark.createDataFrame(
        [("F", f"2025-01-01 0{h}:00:00", 4, 12, 2) for h in range(6)] + [("F", "2025-01-01 06:00:00", 40, 12, 2), ("F", "2025-01-01 07:00:00", 3, 2, 2)],
        "facility_id string, snapshot_datetime_ts string, occupied_beds_int int, staffed_beds_int int, blocked_beds_int int")
    beds = beds.withColumn("snapshot_datetime_ts", F.to_timestamp("snapshot_datetime_ts"))
    weekly = spark.createDataFrame([("F", "2025-01-01", 2)], "nhsn_org_id string, collection_date_d string, all_hospital_inpatient_occupancy_int int")
    row = census_reconciliation(beds, weekly.withColumn("collection_date_d", F.to_date("collection_date_d"))).first()
    assert row["hourly_census"] == 1.0 and row["gap"] == 1.0 and row["within_tolerance"]
