"""Stopping a stream between batches, and knowing what it last did."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from brightloom.streaming.ingest import of_sink

STOP = "a stop was asked for"


class StopRequested(RuntimeError):
    """Ends a query before a batch is touched; the batch is the first one after the next start."""


class StopMarker:
    """A marker in a shared folder, so that any process can ask a stream of another to stop."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def is_set(self) -> bool:
        return not of_sink(self.spark, self.path, "value boolean").isEmpty()

    def set(self) -> None:
        self._write(self.spark.createDataFrame([(True,)], "value boolean"))

    def clear(self) -> None:
        self._write(self.spark.createDataFrame([], "value boolean"))

    def _write(self, df: DataFrame) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(self.path)


def stoppable(write: Callable[[DataFrame, int], None], marker: StopMarker) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that looks at the marker before each batch."""

    def guarded(batch: DataFrame, number: int) -> None:
        if marker.is_set():
            raise StopRequested(f"{STOP} before batch {number}")
        write(batch, number)

    return guarded


def run_until_stopped(query: StreamingQuery, marker: StopMarker, poll_seconds: float = 5.0) -> bool:
    """Wait for the query's end; whether it was stopped by the marker. Any other failure is raised.

    A running batch is never cut off: the guarded writer ends the query before the next one. A query that waits for data
    has no batch to cut off and is stopped here.
    """
    try:
        while not query.awaitTermination(poll_seconds):
            idle = not query.status["isTriggerActive"] and not query.status["isDataAvailable"]
            if idle and marker.is_set():
                query.stop()
                return True
    except StreamingQueryException as ended:
        if STOP not in str(ended):
            raise
        return True
    return False


class CommitLog(StreamingQueryListener):
    """The last batch that each query has committed, by the query's id, and the rows of all its batches so far."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.last: dict[str, int] = {}
        self.rows: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self.ended.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        # sent when a batch is committed
        progress = event.progress
        with self._lock:
            key = str(progress.id)
            if progress.batchId > self.last.get(key, -1):
                self.last[key] = progress.batchId
                self.rows[key] = self.rows.get(key, 0) + progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self.ended[str(event.id)] = event.exception
