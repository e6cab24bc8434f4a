"""Event envelopes: archive replay, file streams and Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampType()), T.StructField("ingest_time", T.TimestampType()),
    T.StructField("source_system", T.StringType()), T.StructField("facility_id", T.StringType()),
    T.StructField("schema_version", T.StringType()), T.StructField("payload", T.StringType()),
])


def read_archive(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Replay of ``<topic>.jsonl[.gz]``; the payload stays JSON text until it is parsed.

    A gzip file is read by one task, so the rows are spread right after the scan.
    """
    events = spark.read.schema(ENVELOPE).json(path)
    return events.repartition(partitions) if partitions else events.hint("rebalance")


def stream_archive(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return (spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch)
            .json(folder))


def stream_kafka(spark: SparkSession, topics: str, **options: str) -> DataFrame:
    """Same columns from Kafka (needs the public spark-sql-kafka package on the cluster)."""
    raw = (spark.readStream.format("kafka").option("subscribe", topics)
           .options(**{k.replace("_", "."): v for k, v in options.items()}).load())
    parsed = F.from_json(F.col("value").cast("string"), ENVELOPE)
    return raw.select(parsed.alias("_e")).select("_e.*")
