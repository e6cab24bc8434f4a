"""Exact duplicates by content hash, with bytes compared inside every group.

Texts are equal when identical after deleting white space (U+0020, U+0009-U+000D); null counts as empty.
Only DataFrame functions run. Narrow rows (id, 128-bit digest, length) are grouped with partial aggregation, so a
group with a third of all rows arrives as one row per map task. Texts move once, and only to be compared: the members
of groups with more than one row meet the text of the row that stays, hot groups dealt over salts that follow the group's
size. A member whose bytes differ (a digest collision) is grouped anew by its bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import ROW, WHITE, numbered, only
from wardflow.session import settle

MEMBERS_PER_SALT = 4096


def without_space(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digest128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _stays() -> Column:
    """Most code points in the original text, then the smallest id, a null id last; of one row given twice, the first read."""
    return F.min(F.struct((-F.col("n_chars")).alias("minus_chars"), F.col("id").isNull().alias("no_id"), "id", "row"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = digest128, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts exactly one row is kept, also where a row is given twice. Empty and null texts form one group.
    A null id sorts as the largest. Other columns of the input, whatever their names, are not read.
    An empty table gives an empty result. Where ``row_col`` numbers the rows, it is returned too, and rows are told apart by it
    among colliding digests as well.
    """
    row = [] if row_col is None else ["row"]
    raw = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                      *[F.col(row_col).alias(r) for r in row])
    bare = raw.select("id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n_chars"),
                      without_space(F.col("text")).alias("bare"), *row)
    keyed = settle(bare.select("id", "n_chars", digest(F.col("bare").cast("binary")).alias("key"),
                               F.sha2("bare", 256).alias("text_sha256"),
                               *(row or [F.monotonically_increasing_id().alias("row")])))
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), _stays().alias("stays"))
    several = settle(groups.filter("n > 1").select(
        "key", "n", F.col("stays.id").alias("keep_id"), (-F.col("stays.minus_chars")).alias("keep_chars"), F.col("stays.row").alias("keep_row")))

    differing = settle(_differing(bare, several, digest))
    which = row or ["id", "n_chars"]
    own = differing.groupBy("key", "bare").agg(
        F.count("*").alias("own_n"), F.min(F.struct((-F.col("n_chars")).alias("m"), F.col("id").isNull().alias("no_id"), "id", *row)).alias("own"))
    apart = (differing.join(own, ["key", "bare"])
             .select(F.col("key").alias("_key"), *[F.col(c).alias(f"_{c}") for c in which], "own_n", F.col("own.id").alias("own_id"),
                     *[F.col("own.row").alias("own_row") for _ in row]).distinct())
    fewer = differing.groupBy("key").agg(F.count("*").alias("gone"))

    all_rows = keyed.join(several, "key", "left").join(fewer, "key", "left")
    met = F.col("key") == F.col("_key")
    for c in which:
        met &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    all_rows = all_rows.join(apart, met, "left")
    alone, regrouped = F.col("n").isNull(), F.col("own_n").isNotNull()
    keep_id = F.when(regrouped, F.col("own_id")).when(alone, F.col("id")).otherwise(F.col("keep_id"))
    size = F.when(regrouped, F.col("own_n")).when(alone, F.lit(1)).otherwise(F.col("n") - F.coalesce("gone", F.lit(0)))
    kept = F.when(regrouped, F.col("own_row") == F.col("row") if row else F.col("own_id").eqNullSafe(F.col("id"))).otherwise(
        alone | (F.col("row") == F.col("keep_row")))
    return all_rows.select(F.col("id").alias("doc_id"), keep_id.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"),
                           "text_sha256", *[F.col(r).alias(row_col) for r in row])


def _differing(bare: DataFrame, several: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Members of groups whose bytes are not those of the row that stays."""
    row = [c for c in bare.columns if c == "row"]
    salts = F.ceil(F.col("n") / MEMBERS_PER_SALT)
    stays = F.col("row") == F.col("keep_row") if row else F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    members = settle(
        bare.withColumn("key", digest(F.col("bare").cast("binary"))).join(several.hint("merge"), "key")
        .select("key", "id", "n_chars", "bare", "n",
                stays.alias("keeper"), F.pmod(F.xxhash64(*(row or ["id"])), salts).cast("int").alias("salt"), *row))
    keepers = (members.filter("keeper").groupBy("key").agg(F.first("bare").alias("kept_text"), F.first("n").alias("n"))
               .select("key", "kept_text", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))).alias("salt")))
    return (members.filter("not keeper").join(keepers, ["key", "salt"])
            .filter(F.col("bare") != F.col("kept_text")).select("key", "id", "n_chars", "bare", *row))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: of equal texts exactly one row, also where ids repeat or are null."""
    rows = numbered(docs)
    return only(rows, exact_groups(rows, row_col=ROW).filter("kept"))


ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY bare) AS group_size,
       row_number() OVER (PARTITION BY bare ORDER BY n DESC, doc_id) = 1 AS kept,
       sha256(bare) AS text_sha256
FROM t
"""
