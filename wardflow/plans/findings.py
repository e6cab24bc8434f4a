"""Defect finder: names every defect of the declared classes, row by row, for scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.parsing import clinical_time, fold, to_double, to_time
from wardflow.operators.audit import stack
from wardflow.operators.joins import with_exists


@dataclass(frozen=True)
class Expectation:
    """What a clean row of one Bronze table looks like."""

    source: str
    key: str
    required: Sequence[str] = ()
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    numbers: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    ordered: Sequence[tuple[str, str]] = ()
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def find_defects(bronze: Callable[[str], DataFrame], wanted: Expectation) -> DataFrame:
    """(source, defect_type, row_key, field) for every finding; one pass, plus one join per parent."""
    df = bronze(wanted.source)
    tests = [("null_required_field", c, F.col(c).isNull()) for c in wanted.required]
    tests += [("invalid_code_value", c, F.col(c).isNotNull() & ~fold(c).isin(*[v.lower() for v in values]))
              for c, values in wanted.domains.items()]
    for c, (low, high) in wanted.numbers.items():
        tests.append(("type_nonconformance", c, F.col(c).isNotNull() & to_double(c).isNull()))
        tests.append(("outlier_numeric", c, ~to_double(c).between(low, high)))
    time = clinical_time if "source_system" in df.columns else to_time
    tests += [("temporal_inversion", f"{a}/{b}", time(b) < time(a)) for a, b in wanted.ordered]
    for i, (c, (parent, parent_key)) in enumerate(wanted.parents.items()):
        df = with_exists(df, bronze(parent), c, parent_key, f"_fk{i}")
        tests.append(("orphan_foreign_key", c, F.col(c).isNotNull() & ~F.col(f"_fk{i}")))
    hits = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(kind).alias("defect_type"), F.lit(column).alias("field")))
        for kind, column, test in tests]))
    row_level = (df.select(F.col(wanted.key).alias("row_key"), F.explode(hits).alias("_h"))
                 .select(F.lit(wanted.source).alias("source"), "_h.defect_type", "row_key", "_h.field"))
    content = [c for c in bronze(wanted.source).columns if c != "_ingested_at"]
    copies = (bronze(wanted.source).groupBy(*content).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
              .select(F.lit(wanted.source).alias("source"), F.lit("duplicate_row").alias("defect_type"),
                      F.col(wanted.key).alias("row_key"), F.lit(wanted.key).alias("field")))
    return stack([row_level, copies])
