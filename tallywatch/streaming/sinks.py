"""Micro-batch sinks that write each batch exactly once, and the ways to run a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallywatch.session import path_exists
from tallywatch.sources.filelog import TRIGGER_INTERVAL

BatchWriter = Callable[[DataFrame, int], None]


def write_batch_once(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch; a batch that is retried after its write finished is left as it is."""
    target = f"{path}/batch_id={batch_id}"
    if not path_exists(df.sparkSession, f"{target}/_SUCCESS"):
        df.write.mode("overwrite").parquet(target)


def fan_out(outputs: dict[str, Callable[[DataFrame], DataFrame]]) -> BatchWriter:
    """One computed batch to several folders, ``{path: rows to write}``; an empty batch writes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            for path, select in outputs.items():
                write_batch_once(select(batch), path, batch_id)
        finally:
            batch.unpersist()

    return write


def start_batches(
    stream: DataFrame, checkpoint: str, write: BatchWriter, interval: str = TRIGGER_INTERVAL, name: str | None = None
) -> StreamingQuery:
    """A long-running query with one micro-batch per interval; a listener knows it by its name."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(processingTime=interval).start()


def drain_batches(stream: DataFrame, checkpoint: str, write: BatchWriter) -> None:
    """Take everything that is available now, then stop; the next call goes on from the checkpoint."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def drain_to_files(
    stream: DataFrame, checkpoint: str, path: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> None:
    """Single output through the file sink, whose commit log makes it exactly-once."""
    writer = stream.writeStream.format(fmt).options(**(options or {})).option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
