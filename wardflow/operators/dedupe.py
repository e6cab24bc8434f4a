"""Row versions, exact copies and lookups."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                   keep_null_keys: bool = False, needed: Iterable[str] | None = None) -> DataFrame:
    """One row per key: the first under ``order`` (SQL order terms), ties broken by all other
    columns descending.

    ``row_number() = 1`` is planned with a partial group limit below the shuffle, so each map
    task sends at most one row per key and a key holding a third of the table costs no more
    than any other.  The total order makes the survivor independent of file layout.  Groups are
    sorted by a hash of the key first: keys that share their first letters cost no comparison of texts.

    ``needed``: the columns that will be read of the result. Those that break ties after the last of them are left out:
    rows that still tie there agree in all that is needed. The keys alone are simply made distinct.
    """
    if needed is not None:
        columns = _up_to_last(df.columns, keys, order, set(needed))
        if columns == list(keys):
            return df.select(*keys).distinct()
        df = df.select(*columns)
    if keep_null_keys:
        missing = " OR ".join(f"`{k}` IS NULL" for k in keys)
        whole = latest_per_key(df.filter(f"NOT ({missing})"), keys, order)
        return whole.unionByName(df.filter(missing))
    by = ", ".join(f"`{k}`" for k in keys)
    terms = [*order, *[f"`{c}` DESC" for c in df.columns if c not in keys]] or ["1"]
    rank = F.expr(f"row_number() OVER (PARTITION BY xxhash64({by}), {by} ORDER BY {', '.join(terms)})")
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _up_to_last(columns: Sequence[str], keys: Sequence[str], order: Sequence[str], needed: set[str]) -> list[str]:
    """Keys, columns of ``order`` and the others up to the last one in ``needed``; the keys alone if nothing else is needed."""
    if needed <= set(keys):
        return list(keys)
    first = [c for c in columns if c not in keys and any(c in re.findall(r"\w+", term) for term in order)]
    others = [c for c in columns if c not in keys and c not in first]
    last = max((i for i, c in enumerate(others) if c in needed), default=-1)
    return [*keys, *others[:last + 1], *first]


def latest_batch(df: DataFrame, keys: Sequence[str], needed: Iterable[str] | None = None) -> DataFrame:
    return latest_per_key(df, keys, ["_batch_id DESC"], needed=needed)


def drop_copies(df: DataFrame, keys: Sequence[str], needed: Iterable[str] | None = None) -> DataFrame:
    """``dropDuplicates`` on a natural key, with a reproducible survivor."""
    return latest_per_key(df, keys, needed=needed)


def latest_child(df: DataFrame, parent: str, when: str) -> DataFrame:
    """One child per parent before a join, so that the join cannot multiply the parent."""
    return latest_per_key(df, [parent], [f"`{when}` DESC"])


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def mrn_crosswalk(patients: DataFrame) -> DataFrame:
    """(record number, facility) -> person, with a flag where two persons share one number."""
    return patients.groupBy("mrn", "source_facility_id").agg(
        F.min("canonical_patient_key").alias("canonical_patient_key"),
        (F.min("canonical_patient_key") != F.max("canonical_patient_key")).alias("is_conflict"),
        F.count(F.lit(1)).alias("records"))


def canonical_names(df: DataFrame, canonical: DataFrame, key: str, name: str) -> DataFrame:
    """Replace spelling variants of ``name`` by the one the key's dimension row carries.

    ``<name>_variant`` keeps what arrived; ``is_unmatched`` marks keys without a canonical name.
    """
    names = canonical.select(key, F.col(name).alias("_canonical"))
    return (df.join(names, key, "left")
            .withColumn(f"{name}_variant", F.col(name))
            .withColumn("is_unmatched", F.col("_canonical").isNull())
            .withColumn(name, F.coalesce("_canonical", name)).drop("_canonical"))
