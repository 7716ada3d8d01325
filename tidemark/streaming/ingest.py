"""The ingest job: change events to the change log, micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import poll_date
from tidemark.operators.newest import newest_per_document
from tidemark.schema import BATCH_INTERVAL, BATCH_PARTITIONS
from tidemark.sinks.batches import BatchCommit, query_id
from tidemark.sinks.change_log import append_change_log, to_change_rows, without_logged
from tidemark.sinks.quarantine import split_rejected, write_quarantine
from tidemark.sources.change_log import filter_events
from tidemark.streaming.control import StopMarker
from tidemark.streaming.events import parse_events


def change_rows(events: DataFrame) -> DataFrame:
    """Newest change per document of one batch, as change-log rows. ``events`` carries ``pollDate``.

    The same function serves a micro-batch and a plain frame.
    """
    return newest_per_document(to_change_rows(events))


def ingest_changes(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    condition: str | None = None,
    partitions: int = BATCH_PARTITIONS,
    interval: str | None = BATCH_INTERVAL,
    on_invalid: str = "fail",
    quarantine: str | None = None,
    stop: StopMarker | None = None,
) -> StreamingQuery:
    """Start the query; ``interval=None`` takes what is there and ends.

    ``on_invalid`` says what happens to unreadable pages and to documents without the required attributes: ``fail`` stops, ``drop`` leaves
    them out, ``quarantine`` writes them with their text, reason, poll day and batch to the folder ``quarantine``, whatever the
    ``condition``. Only complete documents reach the log.

    The poll day is the micro-batch's own time, which the checkpoint keeps, so a replayed batch lands on the same day. Each batch is committed
    under its number (:class:`tidemark.sinks.batches.BatchCommit`), and its rejected events go to a folder of its own, so a crash
    anywhere adds nothing twice to either. A query without any commit may stand for one whose checkpoint was lost: its
    first batch is compared with the log by update id. Give each query its own checkpoint folder, on storage
    that all executors share. With ``stop``, no batch begins once the marker is set (:func:`tidemark.streaming.control.run_until_stopped`).
    """
    if on_invalid not in ("fail", "drop", "quarantine"):
        raise ValueError(f"on_invalid must be fail, drop or quarantine, not {on_invalid!r}: an incomplete document has no place in the log")
    if (on_invalid == "quarantine") != (quarantine is not None):
        raise ValueError("name the quarantine folder with on_invalid='quarantine', and only then")
    events = parse_events(lines, "keep" if quarantine else on_invalid)
    stamped = events.withColumn("pollDate", poll_date(F.current_timestamp()))
    commits: list[BatchCommit] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if stop is not None:
            stop.check()
        spark = batch.sparkSession
        if not commits:
            commits.append(BatchCommit(spark, path, query_id(spark, checkpoint)))
        commit = commits[0]
        if quarantine:
            # both sinks read the batch
            batch.persist()
        try:
            accepted = batch
            if quarantine:
                accepted, rejected = split_rejected(batch)
                if not rejected.isEmpty():
                    write_quarantine(rejected, quarantine, commit.query, batch_id)
            rows = change_rows(filter_events(accepted, condition))
            if commit.is_new():
                rows = without_logged(rows, path)
            commit.append(batch_id, lambda folder: append_change_log(rows, folder, partitions))
        finally:
            if quarantine:
                batch.unpersist()

    writer = stamped.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
