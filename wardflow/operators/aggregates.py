"""Aggregate expressions and shapes shared by measures and KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.parsing import as_col
from wardflow.operators.joins import group_join


def share_of(test: Column) -> Column:
    """Rate: mean of a boolean, over the rows where it is known."""
    return F.avg(test.cast("double"))


def count_where(test: Column) -> Column:
    return F.count_if(test)


def sum_where(test: Column, value: str | Column) -> Column:
    return F.sum(F.when(test, as_col(value)))


def ratio(over: Column, under: Column, otherwise: float | None = None) -> Column:
    """Division that yields ``otherwise`` (NULL by default) on a zero or missing denominator."""
    value = F.try_divide(over.cast("double"), under.cast("double"))
    return value if otherwise is None else F.coalesce(value, F.lit(otherwise))


def distinct_with_blank(value: Column, where: Column | None = None) -> Column:
    """Distinct values in the rows kept by ``where``; a missing value counts as one value."""
    kept = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return (F.count_distinct(F.when(kept, value))
            + F.coalesce(F.max((kept & value.isNull()).cast("int")), F.lit(0))).cast("long")


def top(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a report; ``by`` should end in a unique column.

    Planned as TakeOrderedAndProject: every task keeps k rows.
    """
    return df.orderBy(*by).limit(k)


def spread(df: DataFrame, value: str) -> DataFrame:
    """Distance between the largest and the smallest group value."""
    return df.agg(F.max(value).alias("highest"), F.min(value).alias("lowest"),
                  (F.max(value) - F.min(value)).alias("spread"), F.count(value).alias("groups"))


def with_total(df: DataFrame, by: str, aggregates: Sequence[Column], label: str = "Total") -> DataFrame:
    """Groups plus one total row in a single pass (``is_total`` tells it from a NULL group)."""
    level = F.grouping(by)
    return (df.rollup(by).agg(*aggregates, (level == 1).alias("is_total"))
            .withColumn(by, F.when(F.col("is_total"), F.lit(label)).otherwise(F.col(by).cast("string"))))


def both_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two grouped frames; counts missing on one side are 0."""
    values = [c for c in [*left.columns, *right.columns] if c not in keys]
    return group_join(left, right, keys, "full").na.fill(0, values)


def latest_value_pivot(df: DataFrame, keys: Sequence[str], name: str, value: str, version: str,
                       columns: Mapping[str, str]) -> DataFrame:
    """Tall readings to one wide row; the value with the highest ``version`` wins per cell.

    The cells are listed, so no pass is needed to discover them, and the same expression is
    valid in an append-mode stream.
    """
    cells = []
    for code, column in columns.items():
        hit = F.col(name) == code
        cells.append(F.max_by(F.when(hit, F.col(value)),
                              F.when(hit & F.col(value).isNotNull(),
                                     F.struct(F.col(version), F.col(value)))).alias(column))
    return df.groupBy(*keys).agg(*cells)


def trend(df: DataFrame, day: str, *aggregates: Column) -> DataFrame:
    return df.groupBy(day).agg(*aggregates).orderBy(day)
