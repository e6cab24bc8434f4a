"""Stays against the clock: clipping to days and counting who is present.

Counting never expands a stay into the hours it covers.  Each interval contributes +1 at the
first grid instant it covers and -1 at the first it no longer does; the deltas are summed per
(key, instant) before anything is shuffled by key, and a running sum over the grid (as long as
the calendar, whatever the number of stays) gives the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clip_to_days(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row per calendar day an interval touches, with the part of it inside that day."""
    touched = F.sequence(F.to_date(start), F.to_date(end))
    daily = df.filter(F.col(end) > F.col(start)).withColumn(day, F.explode(touched))
    opens = F.col(day).cast("timestamp")
    closes = F.date_add(day, 1).cast("timestamp")
    return daily.withColumns({"clip_start": F.greatest(F.col(start), opens),
                              "clip_end": F.least(F.col(end), closes)}
                             ).filter("clip_end > clip_start")


def grid_floor(t: Column, grid: str) -> Column:
    return F.date_trunc(grid, t)


def grid_ceil(t: Column, grid: str) -> Column:
    """First grid instant that is not before ``t``."""
    floor = F.date_trunc(grid, t)
    return F.when(floor == t, floor).otherwise(grid_next(floor, grid))


def grid_next(t: Column, grid: str) -> Column:
    return F.timestamp_add(grid.upper(), F.lit(1), t)


def presence(start: str, end: str, grid: str) -> tuple[Column, Column]:
    """Counted at t when start <= t < end; an open end counts for ever."""
    return grid_ceil(F.col(start), grid), grid_ceil(F.col(end), grid)


def within_next(when: str, hours: int, grid: str) -> tuple[Column, Column]:
    """Counted at t when t <= when <= t + hours."""
    first = grid_ceil(F.timestamp_add("HOUR", F.lit(-hours), F.col(when)), grid)
    return first, grid_next(grid_floor(F.col(when), grid), grid)


def deltas(df: DataFrame, keys: Sequence[str], spans: Mapping[str, tuple[Column, Column]],
           at: str = "at") -> DataFrame:
    """Signed changes of every named count, summed per (keys, instant)."""
    entries = []
    for name, (first, stop) in spans.items():
        inside = first.isNotNull() & (stop.isNull() | (stop > first))
        entries += [F.struct(F.when(inside, first).alias("t"), F.lit(name).alias("n"), F.lit(1).alias("d")),
                    F.struct(F.when(inside, stop).alias("t"), F.lit(name).alias("n"), F.lit(-1).alias("d"))]
    changes = df.select(*keys, F.explode(F.array(*entries)).alias("_e")).filter("_e.t IS NOT NULL")
    return changes.groupBy(*keys, F.col("_e.t").alias(at)).agg(
        *[F.sum(F.when(F.col("_e.n") == name, F.col("_e.d")).otherwise(0)).alias(name) for name in spans])


def levels(changes: DataFrame, keys: Sequence[str], names: Sequence[str], at: str = "at") -> DataFrame:
    """Counts from each change of a key on, as running sums of its signed changes: one row per change, none per grid instant."""
    upto = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.withColumns({n: F.sum(F.coalesce(F.col(n), F.lit(0))).over(upto).cast("long") for n in names})


def _filled(steps: DataFrame, keys: Sequence[str], names: Sequence[str], grid: str, at: str, last: DataFrame) -> DataFrame:
    """Every grid instant from a row's own to just before the key's next one (to ``last`` for its last row)."""
    step = F.expr(f"INTERVAL 1 {grid.upper()}")
    following = F.lead(at).over(Window.partitionBy(*keys).orderBy(at))
    return (steps.withColumn("_until", following - step).withColumn("_until", F.coalesce("_until", last.scalar()))
            .select(*keys, F.explode(F.sequence(at, "_until", step)).alias(at), *names))


def running_counts(changes: DataFrame, keys: Sequence[str], names: Sequence[str], grid: str,
                   at: str = "at") -> DataFrame:
    """Counts at every grid instant from a key's first change to the last change of any key.

    Only changes are shuffled and summed; a count is repeated over the instants up to the next change afterwards.
    """
    last = changes.agg(F.max(at).alias("_last"))
    return _filled(levels(changes, keys, names, at), keys, names, grid, at, last)


def total_counts(rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column], grid: str, last: DataFrame,
                 at: str = "at") -> DataFrame:
    """Sums of ``values`` over all keys at every grid instant from the first row to ``last``.

    ``rows`` tells what holds for a key from an instant on (``levels``). Each row counts as the difference from the
    key's row before it; differences are added up per instant, so no key is expanded over the grid.
    """
    order = Window.partitionBy(*keys).orderBy(at)
    named = rows.select(*keys, at, *[F.coalesce(v.cast("long"), F.lit(0)).alias(n) for n, v in values.items()])
    turns = named.select(at, *[(F.col(n) - F.coalesce(F.lag(n).over(order), F.lit(0))).alias(n) for n in values])
    summed = turns.groupBy(at).agg(*[F.sum(n).alias(n) for n in values])
    # one row per grid instant with a change: as long as the calendar
    return _filled(levels(summed, [], list(values), at), [], list(values), grid, at, last)


def counts_over_time(df: DataFrame, keys: Sequence[str], spans: Mapping[str, tuple[Column, Column]],
                     grid: str, at: str = "at") -> DataFrame:
    return running_counts(deltas(df, keys, spans, at), keys, list(spans), grid, at)
