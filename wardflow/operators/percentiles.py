"""Exact percentiles of large groups.

Spark's ``percentile`` keeps every distinct value of a group in one task's memory.  That is the
right tool where the domain is small (days between two dates), and is used there.  For free
values this operator counts (group, value) pairs first and selects the wanted ranks by histograms, level by level:
first over bands of the value's magnitude (steps of about 1 %), then over ``DIGIT`` equal slots between the least and
the largest value of each band that holds a wanted rank, and so on until those bands are short.  Only what is left of
them is ordered.  A slot never decreases with the value, so no estimate is involved and the result equals
linear-interpolation percentiles exactly; and no task orders more than ``SHORT`` values of a band, however close a group's values lie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.joins import group_join
from wardflow.session import settle


#: Slots of a histogram below the first level.
DIGIT = 256
#: Distinct values of a band that one task may order.
SHORT = 50_000


def _band(value: Column) -> Column:
    finite = F.when(F.abs(value) == float("inf"), F.lit(2.0 ** 25)).otherwise(F.log2(F.abs(value) + 1) * 64)
    band = (F.signum(value) * F.floor(finite)).cast("int")  # infinities have the outermost bands
    # never NULL, so that joins on it add no filter and the counts' shuffle is shared by both uses
    return F.coalesce(band, F.lit(0))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      wanted: Mapping[str, float]) -> DataFrame:
    """One row per group with a double column per entry of ``wanted`` (name -> quantile).

    NULLs and NaNs are skipped; groups without any value are absent; infinities are the ends of the order.
    """
    keys = list(keys) or ["_all"]
    base = df.withColumn("_all", F.lit(0)) if keys == ["_all"] else df
    null_safe = [F.coalesce(F.col(k).cast("string"), F.lit("\0")).alias(f"_k{i}")
                 for i, k in enumerate(keys)]
    ids = [f"_k{i}" for i in range(len(keys))]
    counted = settle(base.select(*keys, *null_safe, F.col(value).cast("double").alias("_v"))
                     .filter("_v IS NOT NULL AND NOT isnan(_v)").groupBy(*keys, *ids, "_v")
                     .agg(F.count(F.lit(1)).alias("_n")).withColumn("_band", _band(F.col("_v"))))
    histogram = [F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_distinct")]
    bands = counted.groupBy(*keys, *ids, "_band").agg(*histogram)
    group = Window.partitionBy(*ids)
    upto = group.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    placed = bands.withColumn("_size", F.sum("_n").over(group)).withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("_size") - 1)).alias("at"))
                      for name, q in wanted.items()])
    within_band = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    wanted_ranks = placed.withColumn("_t", F.explode(ranks)).withColumn("_rank", F.explode(F.array_distinct(F.array(
        F.floor("_t.at"), F.ceil("_t.at"))))).withColumns({"_name": F.col("_t.name"), "_at": F.col("_t.at")})
    mine = [*ids, "_name", "_at", "_rank"]
    targets = settle(wanted_ranks.filter(within_band).select(*mine, "_band", "_low", "_high", "_before", "_distinct"))
    inner = counted.join(targets.select(*ids, "_band").distinct(), [*ids, "_band"])
    while (targets.agg(F.max("_distinct")).first()[0] or 0) > SHORT:
        targets = settle(_narrowed(inner, targets, ids, mine, histogram, within_band))
    # bands are told apart by their least value; a short one is ordered whole
    needed = targets.select(*ids, "_band", F.col("_low").alias("_from_v"), F.col("_high").alias("_to_v"), "_before").distinct()
    inside = (Window.partitionBy(*ids, "_from_v").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    ordered = (inner.join(needed, [*ids, "_band"]).filter(F.col("_v").between(F.col("_from_v"), F.col("_to_v")))
               .withColumn("_from", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
               .drop("_before", "_band"))
    hits = (ordered.join(targets.select(*mine, F.col("_low").alias("_from_v")), [*ids, "_from_v"])
            .filter((F.col("_rank") >= F.col("_from"))
                    & (F.col("_rank") < F.col("_from") + F.col("_n"))))
    low, part = F.floor("_at"), F.col("_at") - F.floor("_at")
    picked = (hits.groupBy(*keys, *ids, "_name", "_at")
              .agg(F.max(F.when(F.col("_rank") == F.floor("_at"), F.col("_v"))).alias("_lo"),
                   F.max(F.when(F.col("_rank") == F.ceil("_at"), F.col("_v"))).alias("_hi"))
              .withColumn("_p", F.when(F.col("_at") == low, F.col("_lo")).otherwise(
                  F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part)))
    out = picked.groupBy(*keys, *ids).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_p"))).alias(name) for name in wanted])
    return out.drop(*ids, "_all")


def _narrowed(inner: DataFrame, targets: DataFrame, ids: list[str], mine: list[str], histogram: list[Column], within_band: Column) -> DataFrame:
    """Targets, each with the slot of its band that holds its rank as the new band. A histogram has one row per band and slot."""
    open_ = targets.select(*ids, "_band", F.col("_low").alias("_from_v"), F.col("_high").alias("_to_v"), "_before").distinct()
    width = F.col("_to_v") - F.col("_from_v")
    slot = F.when(width > 0, F.floor((F.col("_v") - F.col("_from_v")) / width * DIGIT)).otherwise(F.lit(0)).cast("int")
    slots = (inner.join(open_, [*ids, "_band"]).filter(F.col("_v").between(F.col("_from_v"), F.col("_to_v")))
             .groupBy(*ids, "_band", "_from_v", "_before", slot.alias("_slot")).agg(*histogram))
    upto = Window.partitionBy(*ids, "_from_v").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifted = slots.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    return (targets.select(*mine, "_band", F.col("_low").alias("_from_v")).join(shifted, [*ids, "_band", "_from_v"])
            .filter(within_band).select(*mine, "_band", "_low", "_high", "_before", "_distinct"))


def medians_with(df: DataFrame, keys: Sequence[str], value: str,
                 wanted: Mapping[str, float], *aggregates: Column) -> DataFrame:
    """Percentiles joined to other aggregates of the same groups (NULL keys included).

    The rows are read by both, so they are computed once and written.
    """
    df = settle(df)
    ranks = exact_percentiles(df, keys, value, wanted)
    plain = df.groupBy(*keys).agg(*aggregates) if keys else df.agg(*aggregates)
    if not keys:
        joined = plain.withColumn("_one", F.lit(1)).join(ranks.withColumn("_one", F.lit(1)),
                                                         "_one", "left").drop("_one")
        return joined
    return group_join(plain, ranks, keys)
