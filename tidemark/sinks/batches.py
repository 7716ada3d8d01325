"""Appending micro-batches to the change log exactly once.

A batch is written to a folder of its own that readers of the log pass over. A small record then commits it, and its files move to
their places under names that follow from the query and the batch. Until the record is there an attempt can be thrown away as a
whole; from then on a replay only has to finish the moves. Nothing of the log is read for that.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from tidemark.sinks.moves import move_files
from tidemark.sources import storage

# Readers pass over names that begin with an underscore.
BATCHES = "_batches"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that a checkpoint folder belongs to; it outlives restarts."""
    return json.loads(storage.first_line(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


class BatchCommit:
    """Commits of one query to one log."""

    def __init__(self, spark: SparkSession, path: str, query: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.query = query
        self._own = f"{self.path}/{BATCHES}/{query}"

    def staged(self, batch: int) -> str:
        return f"{self._own}/batch-{batch}"

    def _record(self, batch: int) -> str:
        return f"{self._own}/{batch}.committed"

    def is_committed(self, batch: int) -> bool:
        return storage.exists(self.spark, self._record(batch))

    def is_new(self) -> bool:
        """No batch of this query was ever committed."""
        if not storage.exists(self.spark, self._own):
            return True
        return not any(name.endswith(".committed") for name, *_ in storage.entries(self.spark, self._own))

    def append(self, batch: int, write: Callable[[str], None]) -> bool:
        """Let ``write`` fill the batch's folder and publish it; says whether it had to. A committed batch is only published."""
        committed = self.is_committed(batch)
        if not committed:
            storage.delete(self.spark, self.staged(batch))
            write(self.staged(batch))
            storage.write_small(self.spark, self._record(batch), "committed\n")
        self._publish(batch)
        self._forget_before(batch)
        return not committed

    def _publish(self, batch: int) -> None:
        """Move the staged files to the same folders of the log; a replay moves what is left."""
        move_files(self.spark, self.staged(batch), self.path, f"{self.query}-{batch}")
        storage.delete(self.spark, self.staged(batch))

    def _forget_before(self, batch: int) -> None:
        """Only the last batch can be replayed: earlier records have done their work."""
        for name, uri, is_folder, _ in storage.entries(self.spark, self._own):
            number = name.removesuffix(".committed")
            if not is_folder and number.isdigit() and int(number) < batch:
                storage.delete(self.spark, uri)
