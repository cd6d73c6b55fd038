"""What a running query reports of its triggers, as metric rows."""

from __future__ import annotations

import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LATEST = 1000  # reports that are kept; older ones go
SCHEMA = "query string, batch long, metric string, value double"


class ProgressRows(StreamingQueryListener):
    """Keeps the latest reports of one query: rows taken in, seconds spent, and when it ended."""

    def __init__(self, name: str):
        self.name = name
        self.rows: deque[tuple[str, int, str, float]] = deque(maxlen=2 * LATEST)
        self.ended = False

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self.name:
            self.rows.append((self.name, progress.batchId, "input_rows", float(progress.numInputRows)))
            self.rows.append((self.name, progress.batchId, "trigger_seconds", progress.durationMs.get("triggerExecution", 0) / 1000.0))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended = True

    def metrics(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), SCHEMA)


def catch_up(query: StreamingQuery) -> int:
    """Wait until the running query has taken all there is; its last batch. Its errors are raised here."""
    query.processAllAvailable()
    return query.lastProgress["batchId"] if query.lastProgress else -1


def stop_cleanly(query: StreamingQuery, listener: ProgressRows, patience: float = 30.0) -> None:
    """Let the batch in hand finish, stop, and wait for the listener to hear of it."""
    query.processAllAvailable()
    query.stop()
    query.awaitTermination()
    until = time.monotonic() + patience
    while not listener.ended and time.monotonic() < until:
        time.sleep(0.05)
