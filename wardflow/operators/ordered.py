"""Global order without a one-task window.

``row_number() over (order by key)`` moves the table into one partition.  Here rows are split
into ranges of the key first; the ranges' boundaries come from a sample of fixed size chosen
by hash, as a scalar subquery, so a row's range depends on its key alone and stays the same when a
lost task is run again.  Each range is numbered (or summed) by itself and shifted by what the
ranges before it hold. There is a range for every ``SPAN`` rows, ``RANGES`` at least and about ``MOST_RANGES`` at most, so
that bounds stay a short list; a row finds its range by binary search.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import settle

RANGES = 128
MOST_RANGES = 4096
SAMPLE = RANGES * 32
SPAN = 250_000


def _places_up_to(bounds: Column, key: Column, most: int) -> Column:
    """How many of the sorted ``bounds``, ``most`` at the outside, are ``key`` or less; by binary search."""
    def step(found: Column, size: Column) -> Column:
        to = found["at"] + size
        fits = (to <= F.size(found["bounds"])) & (F.try_element_at(found["bounds"], to) <= key)
        return F.struct(F.when(fits, to).otherwise(found["at"]).alias("at"), found["bounds"].alias("bounds"))
    sizes = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    start = F.struct(F.lit(0).alias("at"), bounds.alias("bounds"))
    return F.aggregate(sizes, start, step, lambda found: found["at"])


def _with_range(df: DataFrame, keys: Sequence[str], descending: bool = False) -> DataFrame:
    """Add ``_range``.  The sample keeps one key in so many by hash: for each range as many as SAMPLE has for RANGES, to twice that."""
    key = F.struct(*keys)
    rows = df.agg(F.count(F.lit(1)).alias("_rows"))
    ranges = F.least(F.lit(max(RANGES, MOST_RANGES)), F.greatest(F.lit(RANGES), F.floor(rows.scalar() / F.lit(SPAN))))
    one_in = F.greatest(F.lit(1), F.floor(rows.scalar() / (ranges * F.lit(SAMPLE / RANGES)))).cast("long")
    sample = (df.select(key.alias("_key")).filter(F.pmod(F.xxhash64("_key"), one_in) == 0)
              .agg(F.array_sort(F.collect_list("_key")).alias("_sample")))
    step = F.greatest(F.lit(1), F.floor(F.size("_sample") / ranges).cast("int"))
    bounds = sample.withColumn("_step", step).select(F.when(F.size("_sample") > 0, F.transform(
        F.sequence(F.lit(0), F.size("_sample") - 1, F.col("_step")),
        lambda i: F.element_at("_sample", i.cast("int") + 1))).alias("_bounds"))
    numbered = (df.withColumn("_bounds", bounds.scalar())
                .withColumn("_range", _places_up_to(F.col("_bounds"), key, 2 * max(RANGES, MOST_RANGES)))
                .drop("_bounds"))
    return numbered.withColumn("_range", -F.col("_range")) if descending else numbered


def dense_number(df: DataFrame, keys: Sequence[str], name: str, running: bool = False) -> DataFrame:
    """1, 2, 3 … in the order of ``keys``, which must be unique in ``df``.

    Equals ``row_number() over (order by keys)`` (and, the keys being unique, ``dense_rank``).
    Where the first key is itself a running number from 1 up (``running``), spans of ``SPAN`` numbers
    serve as ranges, so there are as many as the data needs, and no sample is taken.
    """
    if running:
        ranged = df.withColumn("_range", F.floor(F.col(keys[0]) / F.lit(SPAN)))
    else:
        ranged = _with_range(df, keys)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    within = Window.partitionBy("_range").orderBy(*keys)
    return (ranged.withColumn("_at", F.row_number().over(within))
            .join(offsets, "_range")
            .withColumn(name, (F.col("_before") + F.col("_at")).cast("long"))
            .drop("_range", "_at", "_before"))


def number_distinct(df: DataFrame, key: str, name: str) -> DataFrame:
    """Two columns: every distinct value of ``key`` and its dense rank.

    The distinct values are read three times (sample, totals, numbering), so they are settled.
    """
    return dense_number(settle(df.select(key).distinct()), [key], name)


def running_total(df: DataFrame, value: str, tiebreak: Sequence[str], name: str) -> DataFrame:
    """Running sum of ``value`` from the largest value down, over the whole frame.

    ``value`` must be a decimal, so that adding range totals gives the very same digits as one
    long sum would.  (value, tiebreak) must be unique.
    """
    ranged = _with_range(df, [value, *tiebreak], descending=True)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
               .select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")))
    within = (Window.partitionBy("_range")
              .orderBy(F.col(value).desc(), *[F.col(t).desc() for t in tiebreak])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.withColumn("_sum", F.sum(value).over(within))
            .join(offsets, "_range")
            .withColumn(name, F.col("_before") + F.col("_sum")).drop("_range", "_sum", "_before"))


def abc_classes(df: DataFrame, key: str, value: str, a: float = 0.80, b: float = 0.95) -> DataFrame:
    """Pareto classes by cumulative share of value, largest first."""
    df = settle(df)  # read for the sample, the range totals, the sums and the grand total
    total = df.agg(F.sum(value).alias("_total"))
    share = running_total(df, value, [key], "cumulative_value").withColumn(
        "cumulative_share",
        F.try_divide(F.col("cumulative_value").cast("double"), total.scalar().cast("double")))
    return share.withColumn("abc_class", F.when(F.col("cumulative_share") <= a, "A")
                            .when(F.col("cumulative_share") <= b, "B").otherwise("C"))
