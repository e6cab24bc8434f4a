"""Row-level data-quality rules.

All rules of a table are evaluated in one projection, whatever their number; a rule whose
predicate is NULL does not fire.  Foreign keys become boolean columns first (a join each), and
are then rules like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.parsing import as_col
from wardflow.operators.joins import key_values, with_exists
from wardflow.session import settle

ISSUES = "_dq_issues"
PASSED = "_dq_passed"


@dataclass(frozen=True)
class Rule:
    """``message`` is recorded on every row where ``fails`` is true; it looks at the columns ``reads`` (None: not told)."""

    message: str
    fails: Callable[[], Column]
    reads: tuple[str, ...] | None = None


def rule(message: str, fails: Callable[[], Column], reads: tuple[str, ...] | None = None) -> Rule:
    return Rule(message, fails, reads)


def required(column: str, message: str | None = None) -> Rule:
    return Rule(message or f"{column} null", lambda: F.col(column).isNull(), (column,))


def parseable(raw: str, typed: str, message: str | None = None) -> Rule:
    """A value is present but did not survive typing."""
    return Rule(message or f"{raw} unparseable",
                lambda: F.col(raw).isNotNull() & F.col(typed).isNull(), (raw, typed))


def in_domain(column: str, values: Sequence, message: str) -> Rule:
    return Rule(message, lambda: ~F.col(column).isin(*values), (column,))


def within(column: str, low: float | None, high: float | None, message: str,
           null_fails: bool = False) -> Rule:
    def fails() -> Column:
        c = F.col(column)
        tests = [c < low] if low is not None else []
        tests += [c > high] if high is not None else []
        if null_fails:
            tests.append(c.isNull())
        out = tests[0]
        for t in tests[1:]:
            out = out | t
        return out
    return Rule(message, fails, (column,))


def in_order(start: str, end: str, message: str) -> Rule:
    return Rule(message, lambda: F.col(end) < F.col(start), (start, end))


def at_most_times(value: str, base: str, factor: float, message: str) -> Rule:
    return Rule(message, lambda: F.col(value) > F.col(base) * factor, (value, base))


def no_more_than(value: str, limit: str, message: str) -> Rule:
    return Rule(message, lambda: F.col(value) > F.col(limit), (value, limit))


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must exist in ``parent.parent_column``.

    ``gated``: only parent rows that passed their own rules count.  ``null_fails``: a missing
    key is an orphan too (the default leaves missing keys to a ``required`` rule, and so also
    covers optional keys).  ``large``: the parent grows with the business, not with the building.
    """

    column: str
    parent: str
    parent_column: str
    message: str
    gated: bool = False
    null_fails: bool = False
    large: bool = False


@dataclass(frozen=True)
class AttachKey:
    """Foreign key check and key lookup in one join: bring ``brings`` over, flag if missing."""

    column: str
    parent: str
    parent_column: str
    brings: str
    message: str


def resolve_keys(df: DataFrame, checks: Iterable[Rule | ForeignKey | AttachKey],
                 parents: Callable[[str, bool], DataFrame],
                 known: Callable[[ForeignKey], DataFrame] | None = None) -> tuple[DataFrame, list[Rule]]:
    """Join what the keys among ``checks`` need; returns plain rules, in the order given.

    ``parents(name, gated)`` supplies a parent table, ``known(foreign_key)`` the written distinct values of a parent's
    key where a caller keeps them for several children; without it those of large parents are written here.
    """
    rules: list[Rule] = []
    for i, item in enumerate(checks):
        if isinstance(item, Rule):
            rules.append(item)
        elif isinstance(item, AttachKey):
            # both inputs are shuffled for this join alone, so AQE can split a heavy key
            side = (parents(item.parent, False)
                    .select(F.col(item.parent_column).alias(item.column), item.brings)
                    .filter(F.col(item.column).isNotNull()))
            df = df.join(side, item.column, "left")
            rules.append(required(item.brings, item.message))
        else:
            values = known(item) if known else parent_keys(item, parents(item.parent, item.gated))
            if item.large and not known:
                values = settle(values)
            df = with_exists(df, values, item.column, item.parent_column, f"_fk{i}", unique=True)
            rules.append(Rule(item.message, _orphan_test(f"_fk{i}", item.column, item.null_fails)))
    return df, rules


def parent_keys(item: ForeignKey, parent: DataFrame) -> DataFrame:
    """The key values a foreign key may have: those of rows that passed, if ``gated``."""
    return key_values(parent.filter(F.col(PASSED)) if item.gated else parent, item.parent_column)


def _orphan_test(flag: str, column: str, null_fails: bool) -> Callable[[], Column]:
    if null_fails:
        return lambda: ~F.col(flag)
    return lambda: F.col(column).isNotNull() & ~F.col(flag)


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_dq_issues`` (``'; '``-joined, each message once, in rule order) and ``_dq_passed``.

    Messages that are not NULL are joined as they come, with no array of them per row; rules that share a message are one test.
    """
    tests: dict[str, Column] = {}
    for r in rules:
        fails = F.coalesce(r.fails(), F.lit(False))
        tests[r.message] = tests[r.message] | fails if r.message in tests else fails
    said = F.concat_ws("; ", *[F.when(fails, F.lit(message)) for message, fails in tests.items()])
    return df.withColumn(ISSUES, said).withColumn(PASSED, F.col(ISSUES) == "")


def tally(df: DataFrame, checks: Sequence[Rule | ForeignKey], known: Callable[[ForeignKey], DataFrame]) -> DataFrame:
    """``judge`` for those who count: one row per verdict with ``rows``, how many rows of ``df`` have it.

    A row becomes its foreign keys and a number with a bit per message. Rows that agree in the last large key and in that number
    are counted before the key is looked up, so that few rows are shuffled for it and a heavy key is one row per task.
    """
    messages = list(dict.fromkeys(c.message for c in checks))
    fails: dict[str, Column] = {}
    for c in checks:
        if isinstance(c, Rule):
            test = F.coalesce(c.fails(), F.lit(False))
            fails[c.message] = fails[c.message] | test if c.message in fails else test
    keys = sorted((c for c in checks if isinstance(c, ForeignKey)), key=lambda c: c.large)

    def bit(message: str, test: Column) -> Column:
        return F.when(test, F.lit(1 << messages.index(message)).cast("long")).otherwise(F.lit(0).cast("long"))

    def columns(of: Sequence[ForeignKey]) -> list[str]:
        return list(dict.fromkeys(k.column for k in of))
    said = F.lit(0).cast("long")
    for message, test in fails.items():
        said = said.bitwiseOR(bit(message, test))
    df = df.select(*columns(keys), said.alias("_said"), F.lit(1).cast("long").alias("rows"))
    for i, key in enumerate(keys):
        if key.large and len(columns(keys[i:])) == 1 and not (i and keys[i - 1].large and keys[i - 1].column == key.column):
            df = df.groupBy(key.column, "_said").agg(F.sum("rows").alias("rows"))
        df = with_exists(df, known(key), key.column, key.parent_column, "_fk", unique=True)
        orphan = _orphan_test("_fk", key.column, key.null_fails)()
        df = df.select(*columns(keys[i + 1:]), F.col("_said").bitwiseOR(bit(key.message, orphan)).alias("_said"), "rows")
    issues = F.concat_ws("; ", *[F.when(F.col("_said").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(m)) for i, m in enumerate(messages)])
    return (df.groupBy("_said").agg(F.sum("rows").alias("rows"))
            .select(issues.alias(ISSUES), (F.col("_said") == 0).alias(PASSED), "rows"))


def add_issue(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Record one more message on an already judged frame (at most once per row)."""
    have = F.filter(F.split(F.col(ISSUES), "; "), lambda m: m != "")
    more = F.when(condition, F.array_union(have, F.array(F.lit(message)))).otherwise(have)
    return df.withColumn("_found", more).withColumns(
        {ISSUES: F.array_join("_found", "; "), PASSED: F.size("_found") == 0}).drop("_found")


def gate(df: DataFrame) -> DataFrame:
    """Only rows without issues go on."""
    return df.filter(F.col(PASSED))


def quarantine(df: DataFrame, impossible: Column) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined); a row whose test is unknown stays clean."""
    bad = F.coalesce(impossible, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def value_or_null(test: str | Column, value: Column) -> Column:
    return F.when(as_col(test), value)
