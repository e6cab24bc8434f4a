"""The dashboards' tables, trend and cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.plans.measures import KPI_SELECTOR, MEASURES, UNIT_NAME, Model
from wardflow.plans.star import Attribute, Slice

FACILITY_NAME = Attribute("dim_facility", "facility_name")
FULL_DATE = Attribute("dim_date", "full_date")

EXECUTIVE = ["Avg Occupancy Rate", "Avg ED Wait (min)", "Readmission Rate", "Total Revenue at Risk",
             "Staffing Coverage"]
OPERATIONAL = ["Current Occupancy", "Staffing Ratio Compliance", "Unit Risk Description", "Active Stockouts"]
OPERATIONAL_CARDS = ["Current Occupancy", "Active Stockouts", "Staffing Ratio Compliance"]


def executive_table(model: Model) -> DataFrame:
    """Facilities by occupancy, highest first, with a total row last."""
    rows = model.evaluate(EXECUTIVE, [FACILITY_NAME], total=True)
    return (rows.withColumn("facility_name", F.when(F.col("is_total"), "Total").otherwise(F.col("facility_name")))
            .orderBy("is_total", F.col("Avg Occupancy Rate").desc_nulls_last(), "facility_name"))


def operational_table(model: Model, facilities: Sequence[str] = ()) -> DataFrame:
    """Units with their risk; stockouts are known per facility and repeat on every unit."""
    return model.evaluate(OPERATIONAL, [UNIT_NAME], facility_slice(facilities))


def facility_slice(facilities: Sequence[str]) -> list[Slice]:
    return [Slice("dim_facility", "facility_name", tuple(facilities))] if facilities else []


def kpi_trend(model: Model, kpi: str = KPI_SELECTOR[0], by: Attribute = FULL_DATE) -> DataFrame:
    """The chosen KPI over time."""
    if kpi not in MEASURES:
        raise KeyError(kpi)
    return model.evaluate([kpi], [by]).filter(F.col(by.column).isNotNull()).orderBy(by.column)


def headline(model: Model, names: Sequence[str] = tuple(EXECUTIVE), where: Sequence[Slice] = ()) -> DataFrame:
    return model.evaluate(list(names), where=where)
