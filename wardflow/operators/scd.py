"""Versioned dimensions (slowly changing, type 2) built from periodic snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.dedupe import latest_per_key
from wardflow.operators.neighbours import neighbour


def versions(df: DataFrame, key: str, at: str = "_batch_id", compress: bool = False,
             close_missing: bool = False, attributes: Sequence[str] = ()) -> DataFrame:
    """``valid_from`` / ``valid_to`` / ``is_current`` for snapshots taken at ``at`` (yyyyMMdd).

    By default every snapshot is a version.  ``compress`` keeps only snapshots whose
    ``attributes`` differ from the one before.  ``close_missing`` ends the last version of a key
    that is absent from the newest snapshot of the whole feed.
    """
    slot = F.substring(at, 1, 6)
    carried = [c for c in df.columns if not c.startswith("_tie")]
    base = df.withColumn("_tie", F.xxhash64(*carried))
    last_seen = None
    if close_missing:
        last_seen = base.groupBy(key).agg(F.max(at).alias("_last_seen"))
    if compress:
        base = base.withColumn("_print", F.xxhash64(*attributes))
        base = neighbour(base, [key], [at, "_tie"], {"_was": "_print"}, slot, forward=False)
        base = base.filter(F.col("_was").isNull() | (F.col("_was") != F.col("_print")))
        base = base.drop("_was", "_print")
    out = neighbour(base, [key], [at, "_tie"], {"valid_to": at}, slot).drop("_tie")
    out = out.withColumn("valid_from", F.col(at))
    if close_missing:
        newest = df.agg(F.max(at).alias("_newest"))
        out = (out.join(last_seen, key, "left").withColumn("_newest", newest.scalar())
               .withColumn("valid_to", F.when(
                   F.col("valid_to").isNull() & (F.col("_last_seen") < F.col("_newest")),
                   F.col("_last_seen")).otherwise(F.col("valid_to")))
               .drop("_last_seen", "_newest"))
    return out.withColumn("is_current", F.col("valid_to").isNull())


def current(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Current rows, one per key, for use as a lookup; of several the newest, then by all other columns."""
    keys = [key] if isinstance(key, str) else list(key)
    return latest_per_key(df.filter("is_current"), keys, ["valid_from DESC"])


def as_of(facts: DataFrame, dimension: DataFrame, key: str, when: str,
          columns: Sequence[str]) -> DataFrame:
    """Left join to the version valid at ``when`` (same yyyyMMdd text as the validity columns).

    An equi-join on the key; a key has at most one version per snapshot, so the interval test
    runs over a short list.
    """
    dim = dimension.select(F.col(key).alias("_key"), "valid_from", "valid_to", *columns)
    valid = ((F.col(key) == F.col("_key")) & (F.col("valid_from") <= F.col(when))
             & (F.col("valid_to").isNull() | (F.col(when) < F.col("valid_to"))))
    return facts.join(dim, valid, "left").drop("_key", "valid_from", "valid_to")
