"""Null-on-error typing of all-string landing columns.

Spark 4 runs in ANSI mode, where a plain cast of ``'93 mg'`` raises.  Every helper here
returns NULL instead, so that a data-quality rule can name the problem.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_double(value: str | Column) -> Column:
    number = as_col(value).try_cast("double")
    return F.when(F.isnan(number), F.lit(None).cast("double")).otherwise(number)


def to_int(value: str | Column) -> Column:
    """``'1.0'`` and ``'1.7'`` both give 1: parse as a number, drop the fraction."""
    return to_double(value).try_cast("int")


def to_money(value: str | Column) -> Column:
    """Exact cents: sums do not drift and do not depend on the order of the rows."""
    return as_col(value).try_cast("decimal(18,2)")


def to_bool(value: str | Column) -> Column:
    return as_col(value).try_cast("boolean")


def to_day(value: str | Column, *formats: str) -> Column:
    """First format that parses wins; without formats, ISO dates.

    A failed attempt costs several times a good one, so texts that lack a separator of a format are not tried with it.
    """
    if not formats:
        return as_col(value).try_cast("date")

    def attempt(f: str) -> Column:
        day = F.try_to_timestamp(as_col(value), F.lit(f)).cast("date")
        marks = [] if "'" in f or "[" in f else sorted(set(f) & set("-/.:"))
        return F.when(reduce(Column.__and__, [F.contains(as_col(value), F.lit(m)) for m in marks]), day) if marks else day
    return F.coalesce(*[attempt(f) for f in formats])


def to_time(value: str | Column, *formats: str) -> Column:
    if not formats:
        return as_col(value).try_cast("timestamp")
    return F.coalesce(*[F.try_to_timestamp(as_col(value), F.lit(f)) for f in formats])


def to_time_by_system(value: str | Column, system: str | Column,
                      formats: Mapping[str, str]) -> Column:
    """Timestamp parse chosen by the row's source system, falling back to ISO.

    The format is never guessed from the value: ``03/04/2026`` is day-first only because the
    system that wrote it is.  A value that is already ISO still parses, since systems have been
    seen to write it whatever their documented format.
    """
    parsed = None
    for name, pattern in formats.items():
        branch = F.try_to_timestamp(as_col(value), F.lit(pattern))
        parsed = (F.when(as_col(system) == name, branch) if parsed is None
                  else parsed.when(as_col(system) == name, branch))
    iso = as_col(value).try_cast("timestamp")
    return iso if parsed is None else F.coalesce(parsed, iso)


#: How clinical systems that do not write ISO date-times write them.
TIME_FORMATS = {"ACADEMIC_CIS": "yyyy-MM-dd'T'HH:mm:ss", "REGIONAL_HIS": "dd/MM/yyyy HH:mm",
                "COMMUNITY_CARE_EHR": "MM/dd/yyyy HH:mm", "URGENTCARE_CLOUD": "yyyy-MM-dd HH:mm"}


def clinical_time(value: str | Column) -> Column:
    """A time of a clinical feed, read as its ``source_system`` writes it."""
    return to_time_by_system(value, "source_system", TIME_FORMATS)


def fold(value: str | Column) -> Column:
    """Case and padding removed, so that ``'HOME '`` and ``'home'`` are one value."""
    return F.lower(F.trim(as_col(value)))


def blank_to_null(value: str | Column) -> Column:
    return F.when(F.trim(as_col(value)) != "", as_col(value))


def number_with_unit(value: str | Column) -> Column:
    """Leading number of texts such as ``'93 mg'`` (for repair reports, never for Silver)."""
    return F.regexp_extract(as_col(value), r"^\s*(-?\d+(?:\.\d+)?)", 1).try_cast("double")


def normal_name(name: str) -> str:
    """Column name without spaces, case or brackets."""
    return name.strip().lower().replace(" ", "_").replace("(", "").replace(")", "")
