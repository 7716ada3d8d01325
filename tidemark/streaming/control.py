"""Stopping a running query between batches, and watching what it does."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.sources import storage


class StopRequested(Exception):
    """A batch was not begun because a stop is asked for."""


class StopMarker:
    """A small file that asks a query to stop. Any process that reaches the store can set it."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path

    def request(self) -> None:
        storage.write_small(self._spark, self.path, "stop\n")

    def is_requested(self) -> bool:
        return storage.exists(self._spark, self.path)

    def clear(self) -> None:
        storage.delete(self._spark, self.path)

    def check(self) -> None:
        """To be called before a batch writes anything."""
        if self.is_requested():
            raise StopRequested(f"{self.path} asks for a stop")


def run_until_stopped(query: StreamingQuery, stop: StopMarker, every_seconds: float = 1.0) -> bool:
    """Wait for the query's end; true if that was the marker's doing.

    A batch that runs when the marker appears is finished and checkpointed. The next one, should it begin, gives up before it writes
    anything and is taken up again after a restart.
    """
    while True:
        try:
            if query.awaitTermination(every_seconds):
                return stop.is_requested()
        except Exception as error:
            if StopRequested.__name__ in str(error) and stop.is_requested():
                return True
            raise
        if stop.is_requested() and not query.status["isTriggerActive"]:
            query.stop()
            return True


class BatchProgress(StreamingQueryListener):
    """Keeps, for each query, the input rows and seconds of its latest batches."""

    def __init__(self, most: int = 1000):
        self.batches: dict[str, list[tuple[int, int, float]]] = {}
        self._most = most

    def onQueryStarted(self, event) -> None:
        self.batches.setdefault(str(event.id), [])

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        kept = self.batches.setdefault(str(progress.id), [])
        kept.append((progress.batchId, progress.numInputRows, progress.durationMs.get("triggerExecution", 0) / 1000))
        del kept[: -self._most]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
