"""Archive and serving sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

FLUSH = "60 seconds"


def _start(writer, path: str | None, available_now: bool) -> StreamingQuery:
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=FLUSH)
    return writer.start(path) if path else writer.start()


def archive(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a Parquet table, flushing every minute (file sink: exactly once)."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    return _start(writer, path, available_now)


def fan_out(stream: DataFrame, checkpoint: str, *sinks: Callable[[DataFrame, int], None],
            available_now: bool = False) -> StreamingQuery:
    """Write every micro-batch to several destinations, computing it once.

    A batch may be replayed after a failure: each sink receives the batch number and must write
    under it (see ``batch_folder``).
    """
    def deliver(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return _start(writer, None, available_now)


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Sink whose output for a batch number is replaced when that batch is replayed."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return write


def split_late(checkpoint: str, on_time: Callable, late: Callable, stream: DataFrame,
               available_now: bool = False) -> StreamingQuery:
    """Late events (see ``classify_late``) to a side table, the rest to the main one."""
    return fan_out(stream, checkpoint, lambda b, n: on_time(b.filter("NOT is_late"), n),
                   lambda b, n: late(b.filter("is_late"), n), available_now=available_now)
