"""Star relationships and the filter context that flows along them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Many-to-one links, fact column -> dimension column.
LINKS = {
    "fact_encounters": {"dim_facility": "facility_key", "dim_unit": "unit_key", "dim_patient": "patient_key",
                        "dim_date": "encounter_date_key:date_key"},
    "fact_admissions": {"dim_facility": "facility_key", "dim_patient": "patient_key",
                        "dim_date": "admit_date_key:date_key"},
    "fact_ed_stays": {"dim_facility": "facility_key", "dim_patient": "patient_key",
                      "dim_date": "stay_date_key:date_key"},
    "fact_transfers": {"dim_facility": "facility_key", "dim_unit": "unit_key", "dim_patient": "patient_key",
                       "dim_date": "transfer_date_key:date_key"},
    "fact_diagnoses": {"dim_facility": "facility_key", "dim_patient": "patient_key"},
    "fact_claims": {"dim_facility": "facility_key", "dim_payer": "payer_key", "dim_patient": "patient_key",
                    "dim_staff": "attending_staff_key:staff_key", "dim_date": "submission_date_key:date_key"},
    "fact_claim_lines": {"fact_claims": "patient_control_number"},
    "fact_claim_adjustments": {"fact_claims": "patient_control_number"},
    "fact_bed_capacity": {"dim_facility": "facility_key", "dim_unit": "unit_key",
                          "dim_date": "snapshot_date_key:date_key"},
    "fact_pharmacy_inventory": {"dim_facility": "facility_key", "dim_drug": "drug_key",
                                "dim_date": "snapshot_date_key:date_key"},
    "fact_staffing": {"dim_facility": "facility_key", "dim_unit": "unit_key", "dim_staff": "staff_key",
                      "dim_date": "work_date_key:date_key"},
}


@dataclass(frozen=True)
class Attribute:
    """A dimension column, e.g. ``Attribute("dim_facility", "facility_name")``."""

    table: str
    column: str


@dataclass(frozen=True)
class Slice:
    """Slicer selection: rows whose dimension column is one of ``values``."""

    table: str
    column: str
    values: tuple


def path(fact: str, table: str) -> list[tuple[str, str, str]] | None:
    """Joins from ``fact`` to ``table`` as (table, from column, to column); None if unrelated."""
    links = LINKS.get(fact, {})
    if table in links:
        source, _, target = links[table].partition(":")
        return [(table, source, target or source)]
    for middle, columns in links.items():
        onward = path(middle, table)
        if onward is not None:
            source, _, target = columns.partition(":")
            return [(middle, source, target or source), *onward]
    return None


def context(tables: Callable[[str], DataFrame], fact: str, by: Sequence[Attribute],
            where: Sequence[Slice]) -> DataFrame:
    """The fact restricted by the slices that reach it, with the ``by`` columns attached.

    A slice on an unrelated table leaves the fact alone.  Rows without a dimension partner stay,
    under a NULL member.
    """
    df = tables(fact)
    wanted: dict[str, list[str]] = {}
    for item in [*by, *where]:
        if path(fact, item.table) is not None:
            wanted.setdefault(item.table, []).append(item.column)
    for table, columns in wanted.items():
        steps = path(fact, table)
        side = None
        for step_table, _, to_column in reversed(steps):
            dim = tables(step_table)
            if side is None:
                fresh = [F.col(c).alias(f"{table}.{c}") for c in dict.fromkeys(columns)]
                side = dim.select(F.col(to_column).alias("_to"), *fresh)
            else:
                onward = next(s for s in steps if s[0] != step_table)
                side = (dim.select(F.col(to_column).alias("_up"), F.col(onward[1]).alias("_to"))
                        .join(side, "_to", "left").drop("_to").withColumnRenamed("_up", "_to"))
        df = df.join(side, F.col(steps[0][1]) == F.col("_to"), "left").drop("_to")
    for item in where:
        if path(fact, item.table) is not None:
            df = df.filter(F.col(f"`{item.table}.{item.column}`").isin(*item.values))
    return df.withColumns({a.column: F.col(f"`{a.table}.{a.column}`") for a in by
                           if path(fact, a.table) is not None})
