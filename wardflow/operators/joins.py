"""Joins that keep their shape when one key holds a third of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32
HOT_SHARE = 1 / 256


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str],
           columns: Sequence[str]) -> DataFrame:
    """Left join to a dimension for a few of its columns.

    No hint: Catalyst broadcasts the dimension if its size is below the configured limit and
    AQE re-decides from the measured size; otherwise it shuffles.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(dimension.select(*keys, *columns), keys, "left")


def group_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two frames grouped by the same keys, a NULL group meeting the other NULL group."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    values = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return left.join(other, condition, how).select(
        *[F.coalesce(k, f"_right_{k}").alias(k) for k in keys], *values)


def hot_keys(df: DataFrame, key: str) -> list | None:
    """Values of ``key`` (None for NULL) that hold more than ``HOT_SHARE`` of the rows each.

    One pass with a frequent-items sketch that is merged map-side, so no key is shuffled; one row
    comes back, holding at most ``1 / HOT_SHARE`` values.  The list only steers how rows are
    spread: a key missed or listed needlessly changes the work, never a result.
    """
    most = int(1 / HOT_SHARE)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("known"),
                 F.expr(f"approx_top_k(`{key}`, {most}, {most * 32})").alias("top")).first()
    least = max(row["rows"] * HOT_SHARE, SALTS)
    hot = [item["item"] for item in row["top"] or [] if item["count"] > least and item["item"] is not None]
    return hot + [None] if row["rows"] - row["known"] > least else hot


def hot_key_join(left: DataFrame, right: DataFrame, on: str, hot: list, how: str = "left") -> DataFrame:
    """``left.join(right, on, how)`` with the rows of the ``hot`` keys spread over ``SALTS`` tasks.

    ``right`` must be unique on ``on``: each hot key's single row is repeated once per salt.
    NULL keys match nothing and are spread as well.  AQE splits skewed joins too, but only where
    both inputs come straight from a shuffle; a side that was just deduplicated or aggregated on
    the join key does not, and that is where this is used.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(how)
    if not hot:
        return left.join(right, on, how)
    values = [h for h in hot if h is not None]
    heavy = F.col(on).isin(*values) if values else F.lit(False)
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
    salted = left.withColumn("_salt", F.when(F.col(on).isNull() | heavy, spread).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = right.withColumn("_salt", F.explode(F.when(heavy, every).otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def key_values(parents: DataFrame, parent_column: str) -> DataFrame:
    """The distinct non-null values of a parent's key, under its own name."""
    return parents.select(parent_column).filter(F.col(parent_column).isNotNull()).distinct()


def with_exists(df: DataFrame, parents: DataFrame, key: str, parent_key: str, flag: str,
                hot: list | None = None, unique: bool = False) -> DataFrame:
    """Boolean ``flag``: does ``key`` exist among the non-null ``parent_key`` values?

    ``unique``: ``parents`` is a written table of distinct values (``settle(key_values(...))``). Then both inputs are
    shuffled for this join alone, and AQE splits a heavy key without being told which it is.
    """
    keys = parents if unique else key_values(parents, parent_key)
    linked = hot_key_join(df, keys.select(F.col(parent_key).alias(key)).withColumn(flag, F.lit(True)), key, hot or [])
    return linked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent."""
    keys = child.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def longest_prefix(df: DataFrame, code: str, prefixes: Mapping[str, str], name: str,
                   default: str) -> DataFrame:
    """Value of the longest prefix of ``code`` found in ``prefixes``.

    Works on the distinct codes: each is exploded into its own prefixes and matched by equality;
    the result joins back by code.
    """
    spark = df.sparkSession
    table = spark.createDataFrame(list(prefixes.items()), "_prefix string, _value string")
    longest = max(len(p) for p in prefixes)
    codes = df.select(F.col(code).alias("_code")).filter("_code IS NOT NULL").distinct()
    # the prefix table is the literal mapping given by the caller
    hits = (codes.withColumn("_n", F.explode(F.sequence(
                F.lit(1), F.least(F.lit(longest), F.greatest(F.lit(1), F.length("_code"))))))
            .withColumn("_prefix", F.substring("_code", F.lit(1), F.col("_n")))
            .join(F.broadcast(table), "_prefix")
            .groupBy("_code").agg(F.max_by("_value", "_n").alias(name)))
    return (df.drop(name).join(hits, F.col(code) == F.col("_code"), "left").drop("_code")
            .withColumn(name, F.coalesce(F.col(name), F.lit(default))))


def attribute_to_index(events: DataFrame, index: DataFrame, link: str, index_key: str,
                       columns: Sequence[str]) -> DataFrame:
    """Give each event the attributes of the index event it points at (inner join)."""
    side = index.select(F.col(index_key).alias(link), *columns)
    return events.drop(*[c for c in columns if c in events.columns]).join(side, link)
