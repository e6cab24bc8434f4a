"""Next / previous row and sequence numbers inside a group that may be huge.

A plain ``lead`` gathers a whole group in one task.  Here a group is cut by ``slot``, a value
that never decreases along the order (a day, a month), so the rows of one hot key spread over
as many tasks as it has slots.  What a row at the edge of a slot needs from the next one is the
slot's first row, found with a plain aggregate; the window that links the slots of a key sees
one row per slot, which the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SPREAD = 32


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              values: dict[str, str], slot: Column, forward: bool = True) -> DataFrame:
    """Add ``{new column: source column}`` taken from the next (or previous) row of the group.

    ``order`` must be total within a group.  Rows with a NULL key or a NULL first order column
    belong to no group: they get NULL, and are spread so that they do not pile up either.
    """
    usable = " AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, order[0]])
    names = [f"`{c}`" for c in df.columns]
    slotted = df.withColumns({
        "_slot": slot,
        "_part": F.expr(f"IF({usable}, 0, 1 + pmod(xxhash64({', '.join(names)}), {SPREAD}))").cast("int")})
    sources = list(dict.fromkeys(values.values()))
    position = F.struct(*order, *[F.col(v).alias(f"_v{i}") for i, v in enumerate(sources)])
    pick, step = (F.min, F.lead) if forward else (F.max, F.lag)
    across = Window.partitionBy(*keys).orderBy("_slot")
    edges = (slotted.filter("_part = 0").groupBy(*keys, "_slot", "_part").agg(pick(position).alias("_own"))
             .withColumn("_edge", step("_own").over(across)).drop("_own"))
    within = Window.partitionBy(*keys, "_slot", "_part").orderBy(*order)
    near = (slotted.withColumn("_local", step(position).over(within))
            .join(edges, [*keys, "_slot", "_part"], "left")
            .withColumn("_near", F.when(F.col("_part") == 0, F.coalesce("_local", "_edge"))))
    return near.select(*df.columns, *[F.col("_near")[f"_v{sources.index(old)}"].alias(new)
                                      for new, old in values.items()])


def sequence_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column,
                      name: str) -> DataFrame:
    """``row_number`` within the group, as SQL numbers it: rows with a NULL key form one group, and rows whose
    ``slot`` is NULL come first.  ``order`` must be total; no row is dropped."""
    slotted = df.withColumn("_slot", slot)
    parts = [*keys, "_slot"]
    before = (Window.partitionBy(*keys).orderBy("_slot")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (slotted.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
               .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
               .drop("_rows"))
    within = Window.partitionBy(*keys, "_slot").orderBy(*order)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in parts])
    return (slotted.withColumn("_at", F.row_number().over(within))
            .join(offsets.withColumnsRenamed({c: f"_of_{c}" for c in parts}), same, "left")
            .withColumn(name, (F.col("_before") + F.col("_at")).cast("int"))
            .select(*df.columns, name))
