"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

A stage takes ``(spark, docs, sf_dir)`` and returns documents it keeps with the columns of ``documents``; the last returns
the packed pieces. What a stage rejects is gone for the next one. Stages decide per row: rows are numbered where a decision is
joined back, so that repeated and null ids do not share one.

What a stage returns is to be written before the next stage begins: then the tables it was made of are discarded.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, exact_dedup, near_join, packing, quality
from wardflow.llm.common import ROW, numbered, only, table, vocabulary
from wardflow.session import discard, settle, watched

_USED_UP: list[DataFrame] = []


def _stage(make):
    """A stage that begins by giving back the disk of the one before."""
    @wraps(make)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(*[t for t in _USED_UP if t.sparkSession.sparkContext is spark.sparkContext])  # those of a stopped session are gone
        _USED_UP.clear()
        with watched() as tables:
            found = make(spark, docs, sf_dir)
        _USED_UP.extend(tables)
        return found
    return begin


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.7 or more; it learns from the labels of documents that came in."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter(F.col("score") >= quality.THRESHOLD).select(*docs.columns)


@_stage
def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one row with most code points, then the smallest id."""
    return exact_dedup.keep_one(docs)


@_stage
def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the one row with the smallest id, a null id being the largest; every row without words."""
    rows = numbered(docs)
    found = near_join.near_duplicates(rows, ROW)
    alone = F.when(F.col("component").isNull(), F.col(ROW)).alias("alone")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)).alias("first")
    return only(rows, found.groupBy("component", alone).agg(first).select(f"first.{ROW}"))


@_stage
def no_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any occurrence of a benchmark window."""
    rows = numbered(docs)
    return only(rows, decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), row_col=ROW).filter(~F.col("contaminated")))


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality classifier", good_quality), ("exact dedup", no_exact_copies), ("n-gram Jaccard join", no_near_copies),
          ("benchmark decontamination", no_benchmark_text), ("best-fit packing", packed)]

#: Learned scores and the packing are not expressible in SQL; tests check every stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
