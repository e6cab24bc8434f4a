"""Named measures, evaluated by any dimension columns under any slices."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.labels import capacity_risk, risk_sentence
from wardflow.operators.aggregates import distinct_with_blank, ratio
from wardflow.operators.joins import group_join
from wardflow.plans.star import Attribute, Slice, context, path
from wardflow.session import settle

UNIT_NAME = Attribute("dim_unit", "unit_name")


@dataclass(frozen=True)
class Measure:
    """An aggregate over one fact.

    ``latest`` names a column whose overall maximum, regardless of slices, the aggregate compares
    with; it is available as ``_latest``.  ``reads``: the fact's columns that the aggregate looks at (None: not told).
    """

    fact: str
    aggregate: Callable[[], Column]
    latest: str | None = None
    reads: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Derived:
    """A column computed from other measures."""

    parts: tuple[str, ...]
    formula: Callable[[], Column]


def _is_latest(column: str) -> Column:
    return F.col(column) == F.col("_latest")


EXPECTED_STAFF = "Expected Staff Needed"

MEASURES: dict[str, Measure | Derived] = {
    "Avg ED Wait (min)": Measure("fact_ed_stays", lambda: F.avg("wait_time_minutes"), reads=("wait_time_minutes",)),
    "Avg Occupancy Rate": Measure("fact_bed_capacity", lambda: F.avg("occupancy_rate"), reads=("occupancy_rate",)),
    "Readmission Count": Measure("fact_admissions", lambda: F.count_if("is_readmission"), reads=("is_readmission",)),
    "Total Admissions": Measure("fact_admissions", lambda: F.count(F.lit(1)), reads=("hadm_id",)),
    "Readmission Rate": Derived(("Readmission Count", "Total Admissions"), lambda: ratio(
        F.col("Readmission Count"), F.col("Total Admissions"), 0.0)),
    "Total Scheduled Hours": Measure("fact_staffing", lambda: F.sum("scheduled_hours"), reads=("scheduled_hours",)),
    "Total Actual Hours": Measure("fact_staffing", lambda: F.sum("actual_hours"), reads=("actual_hours",)),
    "Staffing Coverage": Derived(("Total Actual Hours", "Total Scheduled Hours"), lambda: ratio(
        F.col("Total Actual Hours"), F.col("Total Scheduled Hours"), 0.0)),
    "Total Revenue at Risk": Measure("fact_claims", lambda: F.sum("amount_at_risk"), reads=("amount_at_risk",)),
    "Latest Snapshot Date": Measure("fact_bed_capacity", lambda: F.max("snapshot_datetime_ts"), reads=("snapshot_datetime_ts",)),
    "Current Occupancy": Measure("fact_bed_capacity", lambda: F.avg(
        F.when(_is_latest("snapshot_datetime_ts"), F.col("occupancy_rate"))), "snapshot_datetime_ts", ("occupancy_rate",)),
    "Capacity Risk": Derived(("Current Occupancy",), lambda: capacity_risk("Current Occupancy")),
    "Active Stockouts": Measure("fact_pharmacy_inventory", lambda: distinct_with_blank(
        F.col("drug_key"), F.col("is_stockout") & _is_latest("snapshot_date_key")), "snapshot_date_key", ("drug_key", "is_stockout")),
    "Actual Staff Count": Measure("fact_staffing", lambda: distinct_with_blank(
        F.col("staff_key"), _is_latest("work_date_key")), "work_date_key", ("staff_key",)),
    # needs each unit once, see Model._expected_staff
    EXPECTED_STAFF: Measure("fact_staffing", lambda: F.sum(
        F.try_divide("staffed_beds", "nurse_patient_ratio_target")), reads=("unit_key",)),
    "Staffing Ratio Compliance": Derived(("Actual Staff Count", EXPECTED_STAFF), lambda: ratio(
        F.col("Actual Staff Count"), F.col(EXPECTED_STAFF), 0.0)),
    "Unit Risk Description": Derived(("Current Occupancy",), lambda: risk_sentence(
        UNIT_NAME.column, "Current Occupancy")),
}

# Choices of the KPI selector, in display order.
KPI_SELECTOR = ["Avg Occupancy Rate", "Avg ED Wait (min)", "Readmission Rate"]


class Model:
    """Measures over a supplier of star-schema tables.

    ``columns`` supplies a fact with some of its columns only; the facts of an evaluation are then written once, no wider
    than its measures and attributes need.
    """

    def __init__(self, tables: Callable[[str], DataFrame], columns: Callable[[str, Sequence[str]], DataFrame] | None = None):
        self._tables, self._columns = tables, columns

    def evaluate(self, names: Sequence[str], by: Sequence[Attribute] = (), where: Sequence[Slice] = (),
                 total: bool = False) -> DataFrame:
        """One row per combination of ``by``, one column per measure.

        With ``total``, a row with ``is_total`` holds each measure re-evaluated over everything
        (not a sum of the rows above).  A measure whose fact is unrelated to a ``by`` table
        repeats its overall value.
        """
        needed = list(dict.fromkeys(p for n in names for p in self._base(n)))
        facts: dict[tuple, list[str]] = {}
        for name in needed:
            measure = MEASURES[name]
            related = tuple(a for a in by if path(measure.fact, a.table) is not None)
            kind = name if name == EXPECTED_STAFF else measure.latest
            facts.setdefault((measure.fact, kind, related), []).append(name)
        keys = [a.column for a in by] + (["is_total"] if total else [])
        tables = self._written(needed, [*by, *where])
        grouped, repeated = [], []
        for (fact, _, related), members in facts.items():
            if by and len(related) == len(by) or not by:
                grouped.append(self._grouped(tables, fact, members, by, where, total))
            elif not related:
                repeated.append(self._grouped(tables, fact, members, (), where, False))
            else:
                raise ValueError(f"{members} cannot be split by all of {[a.column for a in by]}")
        if not grouped:
            raise ValueError("no measure is related to the requested attributes")
        out = reduce(lambda a, b: _full_join(a, b, keys), grouped)
        for frame in repeated:
            for column in frame.columns:
                out = out.withColumn(column, frame.select(column).scalar())
        for name in names:
            if isinstance(MEASURES[name], Derived):
                out = out.withColumn(name, MEASURES[name].formula())
        return out.select(*keys, *names)

    def _base(self, name: str) -> list[str]:
        measure = MEASURES[name]
        return [p for part in measure.parts for p in self._base(part)] if isinstance(measure, Derived) else [name]

    def _written(self, measures: Sequence[str], attributes: Sequence[Attribute | Slice]) -> Callable[[str], DataFrame]:
        """The supplier, each fact of ``measures`` holding only what they and the attributes' tables are reached by."""
        read: dict[str, dict[str, None] | None] = {}
        for measure in [MEASURES[m] for m in measures] if self._columns else []:
            links = [steps[0][1] for a in attributes if (steps := path(measure.fact, a.table))]
            have = read.setdefault(measure.fact, {})
            if measure.reads is None or have is None:
                read[measure.fact] = None
            else:
                have.update(dict.fromkeys([*measure.reads, *[measure.latest] * (measure.latest is not None), *links]))
        written = {fact: settle(self._columns(fact, list(columns))) for fact, columns in read.items() if columns}
        return lambda name: written[name] if name in written else self._tables(name)

    def _grouped(self, tables: Callable[[str], DataFrame], fact: str, members: list[str], by: Sequence[Attribute], where: Sequence[Slice],
                 total: bool) -> DataFrame:
        rows = context(tables, fact, by, where)
        keys = [a.column for a in by]
        if members == [EXPECTED_STAFF]:
            return self._expected_staff(tables, rows, keys, total)
        latest = MEASURES[members[0]].latest
        if latest:
            rows = rows.withColumn("_latest", tables(fact).agg(F.max(latest)).scalar())
        aggregates = [MEASURES[m].aggregate().alias(m) for m in members]
        if not total:
            return rows.groupBy(*keys).agg(*aggregates)
        return (rows.rollup(*keys).agg(*aggregates, F.grouping_id().alias("_level"))
                .filter(F.col("_level").isin(0, 2 ** len(keys) - 1))
                .withColumn("is_total", F.col("_level") != 0).drop("_level"))

    def _expected_staff(self, tables: Callable[[str], DataFrame], rows: DataFrame, keys: list[str], total: bool) -> DataFrame:
        """Each unit in the context counts once, whatever its number of shifts."""
        need = tables("dim_unit").select("unit_key", "staffed_beds", "nurse_patient_ratio_target")

        def level(columns: list[str]) -> DataFrame:
            units = rows.select(*columns, "unit_key").distinct().join(need, "unit_key", "left")
            return units.groupBy(*columns).agg(MEASURES[EXPECTED_STAFF].aggregate().alias(EXPECTED_STAFF))

        if not total:
            return level(keys)
        types = dict(rows.select(*keys).dtypes)
        overall = level([]).withColumns({k: F.lit(None).cast(types[k]) for k in keys})
        return (level(keys).withColumn("is_total", F.lit(False))
                .unionByName(overall.withColumn("is_total", F.lit(True))))


def _full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on group keys, NULL members meeting each other; one row each if no keys."""
    if not keys:
        for column in right.columns:
            left = left.withColumn(column, right.select(column).scalar())
        return left
    return group_join(left, right, keys, "full")
