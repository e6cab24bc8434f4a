"""Token ids as ORC files, written in id order and read back.

ORC stores integer lists with run-length encoding and keeps, per stripe and per group of rows, minimum and maximum
of every column; with a Bloom filter on the document id a lookup skips stripes and row groups, and stripes are read in
parallel. Files are range-partitioned by document id and sorted within, so min/max of ``doc_id`` prunes files as well.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.session import settle, shared_folder

END = 2
ROWS_AT_ONCE = 256
ROW_GROUP = 1000


def write_ids(docs: DataFrame, path: str, vocabulary: str, end: int = END) -> None:
    """Encode whole texts and write ``shard, seq, doc_id, ids`` as ORC in ascending doc_id order.

    Null text is empty and has the end id alone. A null doc_id comes first; rows that share a doc_id follow one another
    in the order of a hash of their texts. Other columns are not read. An empty table writes no rows.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from wardflow.llm.encode import encoder
        enc, shard, seq, tail = encoder(vocabulary), TaskContext.get().partitionId(), 0, np.uint32(end).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = [x + tail for x in enc.many(part.column(1).to_pylist())]
                offsets = np.cumsum([0, *[len(x) // 4 for x in ids]], dtype=np.int32)
                flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(seq, seq + n)), part.column(0),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["shard", "seq", "doc_id", "ids"])
                seq += n

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
               .withColumn("_print", F.xxhash64("text"))  # rows of one id or without one are cut into ranges as well
               .repartitionByRange("doc_id", "_print").sortWithinPartitions("doc_id", "_print").drop("_print"))
    (ordered.mapInArrow(encode, "shard int, seq long, doc_id long, ids array<int>").write.mode("overwrite")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", ROW_GROUP).option("compression", "zstd").orc(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``shard, seq, doc_id, ids``; a filter on doc_id is pushed to the ORC reader."""
    return spark.read.schema("shard int, seq long, doc_id long, ids array<int>").orc(path)


def positions(written: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a written id file.

    ``start`` counts the ids of all rows before: a running sum inside each shard, shifted by the totals of earlier
    shards (one row per file).
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            raw = np.ascontiguousarray(flat).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)),
                 pa.array([zlib.crc32(raw[a:b]) for a, b in zip(offsets, offsets[1:])], pa.int64())],
                ["shard", "seq", "doc_id", "n_tokens", "ids_crc32"])

    rows = settle(written.mapInArrow(digest, "shard int, seq long, doc_id long, n_tokens long, ids_crc32 long"))
    in_shard = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        F.col("shard").alias("_shard"),
        F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"))
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)))
            .join(totals, F.col("shard") == F.col("_shard"))
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def written_positions(docs: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Write the id files (to the shared folder where no path is given), read them back, and digest them."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, path, vocabulary)
    return positions(read_ids(spark, path))
