"""Silver and Gold brought up to date by rewriting only the parts that new batches touch.

Every table is written in parts (``_part``): months of its business date, or one part ``all`` where rows carry no date
(reference tables, patients, diagnoses, adjustments). A run takes the Bronze batches no run has taken yet and follows them:

* own parts: months of the new rows, and months in which older versions of the same keys lie;
* parts that refer to a changed parent: rows whose foreign key is among the keys of parent rows that came out different;
* facts: the parts of their Silver table, the parts whose claims got another remittance, and all parts if a dimension
  gave out other surrogate keys (dense numbers may shift when a key arrives).

A part is made of its own Silver rows (they carry the raw columns) and the new rows, since the choice of a surviving row is
the same whether it is made at once or in steps. The result equals a full rebuild. What a run is about to rewrite is logged
before it does so; a run that ends early is made good by the next one, which takes the logged parts as touched.
The lists that come to the driver are months and batch ids, which grow with the calendar and not with the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.calendar import date_key
from wardflow.functions.parsing import to_day
from wardflow.operators.audit import run_summary
from wardflow.operators.quality import AttachKey, ForeignKey
from wardflow.plans.gold import CALENDAR, DIMENSIONS, FACTS, Gold
from wardflow.plans.silver import BUILD_ORDER, TABLES, judge_table
from wardflow.session import discard, settle
from wardflow.sources.feeds import FEEDS
from wardflow.sources.layers import Layers

PART = "_part"
LOG = "refresh_log"
LOG_SCHEMA = "run_id string, event string, table_name string, value string"

#: The date whose month is a row's part.
DATES = {
    "encounters": "Start_ts", "admissions": "admittime_ts", "ed_stays": "intime_ts", "outpatient_visits": "appointment_time_ts",
    "transfers": "intime_ts", "claim_header": "submission_date_d", "remit": "remit_date_d", "bed_hourly": "snapshot_datetime_ts",
    "bed_nhsn": "collection_date_d", "pharmacy_inventory": "snapshot_date_d", "staff_schedules": "work_date_parsed",
}
#: What makes two rows versions of one, where it is not the feed's key; tables of which every row stays have none.
VERSIONED_BY = {"staff_schedules": ["facility_id", "staff_id", "work_date_parsed", "shift_start"], "remit": [], "bed_nhsn": []}

#: Columns of a dimension that facts look up or take.
LOOKED_UP = {
    "dim_facility": ["facility_id", "facility_key"], "dim_unit": ["unit_id", "unit_code", "facility_id", "unit_key"],
    "dim_payer": ["payer_id", "payer_key"], "dim_drug": ["ndc11", "drug_key"],
    "dim_staff": ["staff_id", "npi", "is_current", "staff_key"], "dim_patient": ["canonical_patient_key", "patient_key"],
}


@dataclass(frozen=True)
class FactSource:
    """The Silver table whose rows a fact has, the fact's date key, its dimensions, and Silver tables joined by a key."""

    table: str
    date: str | None
    dimensions: tuple[str, ...] = ()
    joined: tuple[tuple[str, str], ...] = ()


SOURCES = {
    "fact_encounters": FactSource("encounters", "encounter_date_key", ("dim_facility", "dim_unit", "dim_patient")),
    "fact_admissions": FactSource("admissions", "admit_date_key", ("dim_facility", "dim_patient")),
    "fact_ed_stays": FactSource("ed_stays", "stay_date_key", ("dim_facility", "dim_patient")),
    "fact_outpatient_visits": FactSource("outpatient_visits", "visit_date_key",
                                         ("dim_facility", "dim_unit", "dim_patient", "dim_payer")),
    "fact_transfers": FactSource("transfers", "transfer_date_key", ("dim_facility", "dim_unit", "dim_patient")),
    "fact_diagnoses": FactSource("diagnoses", None, ("dim_facility", "dim_patient")),
    "fact_claims": FactSource("claim_header", "submission_date_key", ("dim_facility", "dim_payer", "dim_patient", "dim_staff"),
                              (("remit", "patient_control_number"),)),
    "fact_claim_lines": FactSource("claim_line", "service_date_from"),
    "fact_claim_adjustments": FactSource("remit_adjustment", None),
    "fact_bed_capacity": FactSource("bed_hourly", "snapshot_date_key", ("dim_facility", "dim_unit")),
    "fact_pharmacy_inventory": FactSource("pharmacy_inventory", "snapshot_date_key", ("dim_facility", "dim_drug")),
    "fact_staffing": FactSource("staff_schedules", "work_date_key", ("dim_facility", "dim_unit", "dim_staff")),
}


def _month(key: Column) -> Column:
    return F.coalesce(F.floor(key / 100).cast("string"), F.lit("none"))


def silver_part(name: str) -> Column:
    if name == "claim_line":
        return _month(date_key(to_day("service_date_from")))
    return _month(date_key(DATES[name])) if name in DATES else F.lit("all")


def fact_part(name: str) -> Column:
    date = SOURCES[name].date
    if date is None:
        return F.lit("all")
    return _month(date_key(to_day(date)) if name == "fact_claim_lines" else F.col(date))


def _by_month(name: str) -> bool:
    return name in DATES or name == "claim_line"


def _foreign_keys(name: str) -> list[ForeignKey | AttachKey]:
    return [c for c in TABLES[name].checks if isinstance(c, (ForeignKey, AttachKey))]


def _referred(name: str) -> list[str]:
    """Columns of a Silver table by which others refer to it."""
    columns = {c.parent_column for t in TABLES for c in _foreign_keys(t) if c.parent == name}
    return sorted(columns | {key for s in SOURCES.values() for table, key in s.joined if table == name})


def _values(df: DataFrame) -> set[str]:
    return {r[0] for r in df.distinct().collect()}


class Refresh:
    """One run over the layers; ``touched`` lists, per table written, the parts that were rewritten."""

    def __init__(self, spark: SparkSession, layers: Layers, as_of: str | None = None, calendar: tuple[str, str] = CALENDAR,
                 run_id: str | None = None):
        self.spark, self.layers, self.as_of, self.calendar = spark, layers, as_of, calendar
        self.run_id = run_id or uuid.uuid4().hex
        self.touched: dict[str, list[str]] = {}
        self.changed: dict[str, DataFrame | None] = {}  # rows that came out different; None: the table is new
        self.taken: dict[str, list[str]] = {}
        log = layers.read(LOG) if layers.exists(LOG) else spark.createDataFrame([], LOG_SCHEMA)
        ended = log.filter("event = 'ended'").select("run_id")
        self._open = [tuple(r) for r in log.filter("event = 'touched'").join(ended, "run_id", "left_anti")
                      .select("run_id", "table_name", "value").distinct().collect()]
        self._done = log.filter("event = 'batch'").select("table_name", F.col("value").alias("_batch_id")).distinct()

    def _pending(self, table: str) -> set[str]:
        """Parts that runs which did not end had begun to rewrite."""
        return {part for _, name, part in self._open if name == table}

    def _log(self, entries: list[tuple[str, str, str, str]]) -> None:
        if entries:
            self.layers.append(LOG, self.spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1))

    def _write(self, table: str, rows: DataFrame, parts: set[str] | None) -> DataFrame:
        """Replace ``parts`` (None: the whole table) by ``rows``, which must be settled."""
        filled = _values(rows.select(PART))
        rewritten = sorted(filled if parts is None else parts)
        self._log([(self.run_id, "touched", table, p) for p in rewritten])
        if parts is None:
            self.layers.overwrite(table, rows, [PART])
        else:
            self.layers.replace_partitions(table, rows, [PART])
            self.layers.clear_partitions(table, PART, parts - filled)
        self.touched[table] = rewritten
        return self.layers.read(table)

    # Silver
    def silver(self, name: str) -> None:
        target, bronze = f"silver_{name}", self.layers.read(f"bronze_{name}")
        old = self.layers.read(target) if self.layers.exists(target) else None
        known = self._done.filter(F.col("table_name") == name).select("_batch_id")
        batches = sorted(_values(bronze.select("_batch_id").distinct().join(known, "_batch_id", "left_anti")))
        self.taken[name] = batches
        new = bronze.filter(F.col("_batch_id").isin(batches))
        parts = None if old is None else self._parts(name, old, new, batches)
        if parts is not None and not parts:
            return
        raw = bronze
        if parts is not None and _by_month(name):
            kept = old.filter(F.col(PART).isin(*parts) & ~F.col("_batch_id").isin(batches))
            raw = kept.select(*bronze.columns).unionByName(new)
        judged = judge_table(name, TABLES[name].base(raw), lambda parent, gated: self.layers.read(f"silver_{parent}"), raw)
        rows = settle(judged.withColumn(PART, silver_part(name)))
        if old is None:
            self.changed[name] = None
        elif _referred(name):
            self.changed[name] = self._difference(old.filter(F.col(PART).isin(*parts)), rows, _referred(name), self._pending(target))
        written = self._write(target, rows, parts)
        self.layers.append("dq_run_results", run_summary(written, target, self.run_id))
        discard(rows)

    def _parts(self, name: str, old: DataFrame, new: DataFrame, batches: Sequence[str]) -> set[str]:
        parts = self._pending(f"silver_{name}")
        if batches and not _by_month(name):
            parts = parts | {"all"}
        elif batches:
            keys = VERSIONED_BY.get(name, list(FEEDS[name].keys))
            arrived = TABLES[name].base(new).select(silver_part(name).alias(PART), F.xxhash64(*(keys or ["_batch_id"])).alias("_key"))
            parts |= _values(arrived.select(PART))
            if keys:  # a hash that two keys share only adds a part
                lying = old.select(PART, F.xxhash64(*keys).alias("_key"))
                parts |= _values(lying.join(arrived.select("_key").distinct(), "_key", "left_semi").select(PART))
        for key in _foreign_keys(name):
            parts |= self._referring(old, key.column, key.parent, key.parent_column)
        return parts

    def _referring(self, rows: DataFrame, column: str, parent: str, parent_column: str) -> set[str]:
        """Parts of ``rows`` whose ``column`` names a parent row that came out different."""
        if parent not in self.changed:
            return set()
        different = self.changed[parent]
        if different is None:
            return _values(rows.select(PART))
        keys = different.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
        return _values(rows.select(PART, column).join(keys, column, "left_semi").select(PART))

    @staticmethod
    def _difference(old: DataFrame, new: DataFrame, columns: Sequence[str], pending: set[str]) -> DataFrame:
        """``columns`` of rows that only one side has, and of all rows in parts whose earlier rewriting was not followed up."""
        before, after = old.select(*new.columns), new
        sides = [before.exceptAll(after).select(*columns), after.exceptAll(before).select(*columns)]
        if pending:
            sides.append(after.filter(F.col(PART).isin(*pending)).select(*columns))
        return settle(reduce(DataFrame.unionByName, sides).distinct())

    # Gold
    def gold(self, names: Sequence[str]) -> None:
        moved = {n for n in names if n in LOOKED_UP and self._dimension(n)}
        for name in [n for n in names if n in DIMENSIONS and n not in LOOKED_UP]:
            self.layers.overwrite(name, self._star().table(name))
        for name in [n for n in names if n in SOURCES]:
            self._fact(name, moved)

    def _star(self, source: str | None = None, parts: set[str] | None = None) -> Gold:
        def silver(name: str) -> DataFrame:
            rows = self.layers.read(f"silver_{name}").drop(PART)
            if parts is None:
                return rows
            if name == source:
                return picked
            for key in joined.get(name, ()):
                rows = rows.join(picked.select(key).distinct(), key, "left_semi")
            return rows

        if parts is not None:
            picked = self.layers.read(f"silver_{source}").filter(F.col(PART).isin(*parts)).drop(PART)
        joined = {name: [key] for s in SOURCES.values() if s.table == source for name, key in s.joined}
        return Gold(self.spark, silver, self.as_of, self.calendar)

    def _dimension(self, name: str) -> bool:
        """Write a dimension; did it give out other keys? One that an unfinished run had begun counts as such."""
        columns, old = LOOKED_UP[name], self.layers.read(name) if self.layers.exists(name) else None
        star = self._star()
        if name == "dim_unit":
            star.use(dim_facility=self.layers.read("dim_facility"))
        rows = settle(star.table(name))
        moved = old is None or bool(self._pending(name))
        if not moved:
            before, after = old.select(*columns), rows.select(*columns)
            moved = not (before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty())
        if moved:
            self._log([(self.run_id, "touched", name, "all")])
            self.touched[name] = ["all"]
        self.layers.overwrite(name, rows)
        discard(rows)
        return moved

    def _fact(self, name: str, moved: set[str]) -> None:
        made = SOURCES[name]
        source = f"silver_{made.table}"
        if not self.layers.exists(name) or moved & set(made.dimensions):
            parts = None
        else:
            parts = set(self.touched.get(source, [])) | self._pending(name) | self._pending(source)
            for table, key in made.joined:
                parts |= self._referring(self.layers.read(source), key, table, key)
            if not parts:
                return
        star = self._star(made.table, parts)
        star.use(**{d: self.layers.read(d) for d in made.dimensions})
        rows = settle(star.table(name).withColumn(PART, fact_part(name)))
        self._write(name, rows, parts)
        discard(rows)

    def end(self) -> None:
        """The batches taken are done, and so are the runs this one made good."""
        batches = [(self.run_id, "batch", name, b) for name, taken in self.taken.items() for b in taken]
        runs = sorted({run for run, _, _ in self._open} | {self.run_id})
        self._log([*batches, *[(run, "ended", "", "") for run in runs]])
        discard(*[d for d in self.changed.values() if d is not None])


def refresh(spark: SparkSession, layers: Layers, as_of: str | None = None, silver: Sequence[str] = tuple(BUILD_ORDER),
            gold: Sequence[str] = tuple(DIMENSIONS + FACTS), calendar: tuple[str, str] = CALENDAR,
            run_id: str | None = None) -> dict[str, list[str]]:
    """Take new Bronze batches into Silver and Gold; returns the parts rewritten per table.

    The first run writes everything. Tables written by ``build_silver`` and ``build_gold`` have no parts and are not
    continued: use one or the other on a set of layers.
    """
    run = Refresh(spark, layers, as_of, calendar, run_id)
    for name in [n for n in BUILD_ORDER if n in silver]:
        run.silver(name)
    run.gold([n for n in [*DIMENSIONS, *FACTS] if n in gold])
    run.end()
    return run.touched
