import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import calendar, clinical, identity, labels, parsing


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


def test_typing_never_raises(spark):
    cases = [("12", 12), ("1.0", 1), ("1.9", 1), ("-3", -3), ("93 mg", None), ("nan", None), ("", None), ("1e12", None), (None, None)]
    df = spark.createDataFrame([(raw,) for raw, _ in cases], "raw string").select(parsing.to_int("raw").alias("v"))
    assert [r["v"] for r in df.collect()] == [want for _, want in cases]
    assert one(spark, parsing.to_double("a"), a="nan") is None
    assert one(spark, parsing.to_bool("a"), a="1") is True and one(spark, parsing.to_bool("a"), a="maybe") is None
    assert str(one(spark, parsing.to_money("a"), a="12.345")) == "12.35"
    assert one(spark, parsing.to_day("a"), a="not a day") is None


def test_two_date_formats_are_one_day(spark):
    for text in ("2026-08-05", "08/05/2026"):
        assert one(spark, parsing.to_day("a", "yyyy-MM-dd", "MM/dd/yyyy"), a=text) == dt.date(2026, 8, 5)


def test_day_first_only_for_its_system(spark):
    formats = {"DAY_FIRST": "dd/MM/yyyy HH:mm", "MONTH_FIRST": "MM/dd/yyyy HH:mm"}
    df = spark.createDataFrame([("DAY_FIRST", "03/04/2026 10:00"), ("MONTH_FIRST", "03/04/2026 10:00"),
                                ("OTHER", "2026-04-03 10:00:00"), ("DAY_FIRST", "2026-04-03 10:00:00"),
                                ("OTHER", "03/04/2026 10:00")], "s string, t string")
    got = [r["x"] for r in df.select(parsing.to_time_by_system("t", "s", formats).alias("x")).collect()]
    april, march = dt.datetime(2026, 4, 3, 10), dt.datetime(2026, 3, 4, 10)
    assert got == [april, march, april, april, None]


def test_calendar(spark):
    days = calendar.with_calendar(calendar.days(spark, "2025-01-01", "2027-12-31"))
    assert days.count() == 1095
    row = days.filter("date_key = 20270102").first()
    assert (row["day_of_week"], row["day_name"], row["is_weekend"], row["quarter"]) == (7, "Saturday", True, 1)
    assert one(spark, calendar.iso_year("d"), d=dt.date(2027, 1, 1)) == 2026
    assert one(spark, calendar.date_key("d"), d=dt.date(2026, 3, 9)) == 20260309


def test_news2_and_alarms(spark):
    for parameter, value, score in [("heart_rate", 40, 3), ("heart_rate", 41, 1), ("heart_rate", 131, 3), ("spo2", 96, 0),
                                    ("systolic_bp", 219, 0), ("systolic_bp", 220, 3), ("temperature", 39.1, 2),
                                    ("respiratory_rate", 25, 3), ("respiratory_rate", 9, 1)]:
        assert one(spark, clinical.news2_points(parameter, "v"), v=float(value)) == score, (parameter, value)
    assert one(spark, clinical.news2_points("spo2", F.lit(None).cast("double")), v=1) is None
    assert one(spark, clinical.is_alarm("c", "v"), c="8867-4", v=131.0) is True
    assert one(spark, clinical.is_alarm("c", "v"), c="8462-4", v=10.0) is False
    assert one(spark, clinical.is_alarm("c", F.lit(None).cast("double")), c="8867-4") is False


def test_labels(spark):
    assert one(spark, labels.capacity_risk(F.lit(None).cast("double"))) == "OK"
    assert [one(spark, labels.capacity_risk("r"), r=r) for r in (0.79, 0.80, 0.90)] == ["OK", "Watch", "Critical"]
    assert one(spark, labels.risk_sentence("u", "r"), u="ICU", r=0.95) == "ICU is at 95% occupancy — approaching capacity"
    assert one(spark, labels.age_band("b", "2026-01-01"), b=dt.date(2020, 1, 1)) == "0-17"
    assert one(spark, labels.age_band(F.lit(None).cast("date"), "2026-01-01")) == "65+"


def test_person_key(spark):
    key = identity.mpi_key("s", "b", "l", "f", "z")
    assert one(spark, key, s="123", b="x", l="A", f="B", z="0") == "ssn:123"
    assert one(spark, key, s="  ", b="2000", l="Doe", f="Jo", z="02") == "demo|2000|doe|jo|02"


def test_deidentify_and_roles(spark):
    df = spark.createDataFrame([("1", "x", "m1", "F")], "Id string, SSN string, mrn string, Gender string")
    safe = identity.deidentify(df, hashed=["mrn"])
    assert safe.columns == ["Id", "mrn", "Gender"] and safe.first()["mrn"] != "m1"
    assert identity.role_view(safe, ["Id"]).first()["Gender"] is None


def test_clinical_times_follow_the_source_system(spark):
    from wardflow.functions.parsing import clinical_time
    rows = [("REGIONAL_HIS", "03/04/2026 10:00"), ("COMMUNITY_CARE_EHR", "03/04/2026 10:00"), ("ACADEMIC_CIS", "2026-04-03T10:00:00"),
            ("CENTRAL_HIS", "2026-04-03 10:00:00"), ("CENTRAL_HIS", "03/04/2026 10:00"), (None, "2026-04-03 10:00:00"), ("REGIONAL_HIS", "soon")]
    df = spark.createDataFrame(rows, "source_system string, t string")
    got = [str(r[0]) for r in df.select(clinical_time("t")).collect()]
    april, march = "2026-04-03 10:00:00", "2026-03-04 10:00:00"
    assert got == [april, march, april, april, "None", april, "None"]
