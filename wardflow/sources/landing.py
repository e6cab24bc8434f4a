"""Bronze: all-string landing of dated files, once per file.

A ledger table per feed holds the files that have landed. A run lists the folder, takes what the ledger does not have, and opens
only that: its work follows the delivery, not the history.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.feeds import FEEDS, Feed
from wardflow.sources.layers import Layers
from wardflow.sources.workbook import read_workbooks

BATCH = r"_(\d{8})\.[A-Za-z]+(?:\.gz)?$"


def with_provenance(df: DataFrame, file_name: str = "_file") -> DataFrame:
    return (df.withColumn("_ingested_at", F.current_timestamp())
            .withColumn("_source_file", F.col(file_name))
            .withColumn("_batch_id", F.regexp_extract(F.col(file_name), BATCH, 1)).drop(file_name))


def read_feed(spark: SparkSession, root: str, feed: Feed, paths: Sequence[str] | None = None) -> DataFrame:
    """Every file of a feed, or the given ones, as strings.

    The declared schema names columns, and a file whose header disagrees (order included) fails
    instead of landing values under the wrong names.
    """
    paths = list(paths or [f"{root}/{feed.folder}/*.{_kind(feed)}"])
    if feed.workbook:
        return with_provenance(read_workbooks(spark, paths, feed.columns))
    rows = spark.read.schema(feed.schema).option("header", True).option("enforceSchema", False).csv(paths)
    return with_provenance(rows.select(*feed.columns, F.col("_metadata.file_name").alias("_file")))


def _kind(feed: Feed) -> str:
    return "xlsx" if feed.workbook else "csv"


def not_landed(spark: SparkSession, root: str, feed: Feed, layers: Layers) -> DataFrame:
    """Listed files that the ledger does not have; nothing is opened. A name that has landed is never landed again."""
    listed, ledger = list_files(spark, root, feed), f"landed_{feed.table}"
    if not layers.exists(ledger):
        return listed
    return listed.join(layers.read(ledger).select("file").distinct(), "file", "left_anti").select(*listed.columns)


def land(spark: SparkSession, root: str, feed: Feed, layers: Layers) -> None:
    """Add new files to the Bronze table, then to the ledger.

    Each file owns a partition below its batch and is written by replacing that partition, so a run that died half-way, also
    between table and ledger, is repaired by running it again, and a file that comes late to a landed batch is added to it.
    The new names go through the driver, where Spark's reader needs them anyway.
    """
    new = not_landed(spark, root, feed, layers).collect()
    if not new:
        return
    rows = read_feed(spark, root, feed, [r["path"] for r in new])
    layers.replace_partitions(f"bronze_{feed.table}", rows, ["_batch_id", "_source_file"])
    layers.append(f"landed_{feed.table}", spark.createDataFrame(
        [(r["file"], r["batch_id"], r["length"]) for r in new], "file string, batch_id string, length long").coalesce(1))


def land_all(spark: SparkSession, root: str, layers: Layers, tables: Iterable[str] = FEEDS) -> None:
    for table in tables:
        land(spark, root, FEEDS[table], layers)


def list_files(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """One row per delivered file, including files without rows (the content is not read)."""
    files = spark.read.format("binaryFile").load(f"{root}/{feed.folder}/*.{_kind(feed)}")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.lit(feed.table).alias("feed"), name.alias("file"),
                        F.regexp_extract(name, BATCH, 1).alias("batch_id"), "length", "path")


def profile_headers(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """Distinct header lines of a feed against the declared columns."""
    lines = spark.read.text(f"{root}/{feed.folder}/*.csv")
    declared = ",".join(feed.columns)
    # a header is the line that starts with the declared first column or holds no digit
    header = F.col("value").rlike("^" + re.escape(feed.columns[0]) + r"(,|$)") | ~F.col("value").rlike(r"\d")
    return (lines.filter(header).groupBy(F.col("value").alias("header"))
            .agg(F.count_distinct("_metadata.file_name").alias("files"))
            .withColumn("matches", F.col("header") == declared))
