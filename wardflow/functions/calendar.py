"""Date keys, calendar attributes and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.parsing import as_col


def date_key(value: str | Column) -> Column:
    """Integer ``yyyyMMdd``."""
    c = as_col(value)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    return (F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))) / F.lit(60)


def hours_between(start: str | Column, end: str | Column) -> Column:
    return (F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))) / F.lit(3600)


def iso_year(value: str | Column) -> Column:
    """Year the ISO week belongs to (1 January may still be in last year's week 53)."""
    return F.extract(F.lit("YEAROFWEEK"), as_col(value))


def days(spark: SparkSession, first: str, last: str, name: str = "full_date") -> DataFrame:
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(span).alias(name))


def with_calendar(df: DataFrame, day: str = "full_date") -> DataFrame:
    """Attributes of a calendar dimension for a frame holding one row per day."""
    d = F.col(day)
    return df.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("iso_week"), F.quarter(d).alias("quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )
