"""Human-facing bands and sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.parsing import as_col


def age_band(birth: str | Column, as_of: str | Column) -> Column:
    """Age band at ``as_of``, with years of 365 days.  An unknown birth date counts as 65+."""
    reference = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    age_days = F.datediff(reference, as_col(birth))
    return (F.when(age_days < 18 * 365, "0-17").when(age_days < 35 * 365, "18-34")
            .when(age_days < 50 * 365, "35-49").when(age_days < 65 * 365, "50-64")
            .otherwise("65+"))


def capacity_risk(rate: str | Column, critical: float = 0.90, watch: float = 0.80) -> Column:
    """A missing rate reads as OK, like a blank in the dashboard it feeds."""
    r = as_col(rate)
    return F.when(r >= critical, "Critical").when(r >= watch, "Watch").otherwise("OK")


def percent(value: str | Column) -> Column:
    return F.concat(F.round(as_col(value) * 100).cast("int").cast("string"), F.lit("%"))


def risk_sentence(unit: str | Column, rate: str | Column) -> Column:
    start = F.concat(as_col(unit), F.lit(" is at "), percent(rate))
    level = capacity_risk(rate)
    return (F.when(level == "Critical", F.concat(start, F.lit(" occupancy — approaching capacity")))
            .when(level == "Watch", F.concat(start, F.lit(" occupancy — monitor closely"))))
