"""Clinical value rules: monitor alarms, NEWS2, code labels, severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.parsing import as_col

# LOINC codes of the six monitored parameters and the column each becomes.
VITALS = {
    "8867-4": "heart_rate",
    "8480-6": "systolic_bp",
    "8462-4": "diastolic_bp",
    "9279-1": "respiratory_rate",
    "8310-5": "temperature",
    "2708-6": "spo2",
}

# Readings outside (low, high) score 3 on their own. None = no limit on that side.
ALARM_LIMITS = {
    "8867-4": (40, 131),
    "8480-6": (90, 220),
    "9279-1": (8, 25),
    "8310-5": (35.0, None),
    "2708-6": (91, None),
}

# Royal College of Physicians NEWS2 chart. Each entry is (upper bound, score) in
# ascending order; a reading takes the score of the first bound it does not exceed.
NEWS2_BANDS = {
    "respiratory_rate": [(8, 3), (11, 1), (20, 0), (24, 2), (None, 3)],
    "spo2": [(91, 3), (93, 2), (95, 1), (None, 0)],
    "systolic_bp": [(90, 3), (100, 2), (110, 1), (219, 0), (None, 3)],
    "heart_rate": [(40, 3), (50, 1), (90, 0), (110, 1), (130, 2), (None, 3)],
    "temperature": [(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1), (None, 2)],
}
NEWS2_URGENT = 5
NEWS2_EMERGENCY = 7

# Code prefix -> diagnosis family (the longest matching prefix decides).
DRG_FAMILY_PREFIXES = {
    "A41": "SEPSIS", "R65": "SEPSIS", "I50": "HF", "J44": "COPD", "J18": "PN", "J15": "PN",
    "I21": "AMI", "E11.22": "RENAL", "E11": "DIABETES", "N17": "RENAL", "N18": "RENAL",
    "I63": "STROKE", "N39": "UTI", "I48": "ARRHYTHMIA", "J96": "RESP_FAILURE",
    "K92": "GI_BLEED", "A04": "GI_INFECTION", "E86": "FLUID_ELECTROLYTE",
    "I10": "HYPERTENSION", "R07": "CHEST_PAIN", "R10": "OTHER_MEDICAL",
}
DEFAULT_FAMILY = "OTHER_MEDICAL"
# Prefixes of chronic conditions.
CHRONIC_PREFIXES = ["E11", "I10", "I50", "J44", "N18", "I48"]


def is_alarm(loinc: str | Column, value: str | Column) -> Column:
    """Would the bedside monitor alarm on this single reading?  NULL readings never alarm."""
    v = as_col(value)
    tests = []
    for code, (low, high) in ALARM_LIMITS.items():
        outside = v <= low if high is None else (v <= low) | (v >= high)
        tests.append((as_col(loinc) == code) & outside)
    verdict = tests[0]
    for test in tests[1:]:
        verdict = verdict | test
    return F.coalesce(verdict, F.lit(False))


def news2_points(parameter: str, value: str | Column | None = None) -> Column:
    """Score of one parameter; NULL where the reading is missing."""
    v = as_col(value if value is not None else parameter)
    points = F.when(v.isNull(), F.lit(None).cast("int"))
    for bound, score in NEWS2_BANDS[parameter]:
        points = points.otherwise(F.lit(score)) if bound is None else points.when(v <= bound, score)
    return points


def chronic(code: str | Column) -> Column:
    alternatives = "|".join(p.replace(".", r"\.") for p in CHRONIC_PREFIXES)
    return as_col(code).rlike(f"^(?:{alternatives})")


def readmission_risk(code: str | Column, cohort: str | Column) -> Column:
    return (F.when(as_col(cohort) != "OTHER", "high")
            .when(chronic(code), "medium").otherwise("low"))


def severity_tier(icu: Column, los_days: Column, expired: Column) -> Column:
    """MCC / CC / NONE from ICU exposure, a stay of over six days, and death."""
    points = sum(F.coalesce(c, F.lit(False)).cast("int") for c in (icu, los_days > 6, expired))
    return F.when(points >= 2, "MCC").when(points == 1, "CC").otherwise("NONE")
