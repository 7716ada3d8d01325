"""Writing the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import poll_date
from tidemark.functions.identity import update_id
from tidemark.functions.payload import text_to_bytes
from tidemark.operators.ordering import sort_documents
from tidemark.schema import CHANGE_PARTITIONS, CHANGE_SCHEMA, TEXT
from tidemark.session import scratch_path, stage
from tidemark.sources import storage
from tidemark.sources.change_log import read_change_log


def to_change_rows(events: DataFrame, received: Column | None = None) -> DataFrame:
    """Events with metadata columns and JSON ``value`` to change-log rows.

    A deleted change carries no payload. ``received`` is the batch time that gives the poll day; without it the
    frame must hold a ``pollDate`` column.
    """
    day = poll_date(received) if received is not None else F.col("pollDate")
    identity = update_id(*[F.col(c) for c in ("table", "key", "version", "lastUpdateTs", "deleted", "value")])
    payload = text_to_bytes(F.when(~F.col("deleted"), F.col("value")))
    return events.select(
        identity.alias("updateId"),
        "table",
        "key",
        "version",
        "lastUpdateTs",
        "deleted",
        F.lit(TEXT).alias("encoding"),
        payload.alias("content"),
        day.alias("pollDate"),
    )


def append_change_log(rows: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append in ``(table, key)`` order, one directory per poll day and table.

    The day leads the sort: a micro-batch has one, and a backfill of many then still touches each directory from
    few tasks. Starting with the partition columns also spares the writer a sort of its own. Without ``partitions``
    the number of tasks follows the size of the rows. The rows are computed once, however dear they are: they are written to
    the shared scratch area first, and finding the ranges reads the sort columns there.
    """
    spark = rows.sparkSession
    work = scratch_path(spark, "append")
    try:
        rows = stage(rows.select(*CHANGE_SCHEMA.fieldNames()), "rows", work)
        ordered = sort_documents(rows, partitions, leading=("pollDate",))
        ordered.write.mode("append").partitionBy(*CHANGE_PARTITIONS).parquet(path)
    finally:
        storage.delete(spark, work)


def without_logged(rows: DataFrame, path: str) -> DataFrame:
    """Drop the rows that the log already holds for their poll days.

    Makes the replay of an append harmless when an earlier attempt wrote part of it: update ids are derived from
    the change, so the replay repeats them. Reads the ids of the replayed days only.
    """
    spark = rows.sparkSession
    if not storage.exists(spark, path):
        return rows
    on = ["pollDate", "table", "updateId"]
    # only the rows' days are read: the semi-join prunes the log's directories at run time. There are no more days than
    # the calendar has, so they can be broadcast
    logged = read_change_log(spark, path).join(F.broadcast(rows.select("pollDate").distinct()), "pollDate", "left_semi")
    return rows.join(logged.select(*on), on, "left_anti")
