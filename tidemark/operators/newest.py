"""Newest change per document, first copy per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from tidemark.operators.table_set import TableSet
from tidemark.schema import CHANGE_ORDER, DOCUMENT_KEY, POSITION_COLUMNS
from tidemark.sources.change_log import window_changes


def newest_per_document(changes: DataFrame) -> DataFrame:
    """One row per ``(table, key)``: the greatest ``(version, lastUpdateTs, updateId)``.

    Spark keeps only the first-ranked row per key of each map task before the shuffle, so a document that
    owns a third of the log crosses the network once per task. The result is hash-partitioned and sorted by
    ``(table, key)``, which a join on these columns reuses.
    """
    return _first_ranked(changes, [F.col(c).desc() for c in CHANGE_ORDER])


def _first_ranked(df: DataFrame, order) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*DOCUMENT_KEY).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def changes_of_live_tables(changes: DataFrame, live: TableSet) -> DataFrame:
    return live.keep(changes)


def latest_changes(changes: DataFrame, days: list[str] | None = None, live: TableSet | None = None) -> DataFrame:
    """Newest change per document within the window, of live tables only. Deleted ones are still in."""
    if days is not None:
        changes = window_changes(changes, days)
    if live is not None:
        changes = changes_of_live_tables(changes, live)
    return newest_per_document(changes)


def latest_change_ids(changes: DataFrame, days: list[str] | None = None, live: TableSet | None = None) -> DataFrame:
    """The same pick without the payload: only narrow columns are read and shuffled."""
    narrow = changes.select(*DOCUMENT_KEY, *CHANGE_ORDER, "deleted", "encoding", "pollDate")
    return latest_changes(narrow, days, live)


def drop_tombstones(newest: DataFrame) -> DataFrame:
    """Remove deletes; only valid after the newest pick, else an older version would come back."""
    return newest.where(~F.col("deleted"))


# What finds a picked change in the log again.
PAYLOAD_KEY = [*DOCUMENT_KEY, "updateId", "pollDate"]


def change_payloads(changes: DataFrame, ids: DataFrame, small_ids: bool = False, along: tuple[str, ...] = ()) -> DataFrame:
    """Fetch encoding and payload of the picked changes from the log.

    ``ids`` comes from :func:`latest_change_ids`. The poll day is part of the join, as a redelivered change has
    the same id on another day; a row written twice on one day counts once. ``small_ids`` says that the caller
    has measured ``ids`` and a broadcast is safe; then log rows that lost never leave their scan task. For more ids,
    let a :class:`tidemark.operators.key_filter.KeyFilter` over them take the losers out of ``changes`` first. The columns
    ``along`` of ``ids`` come with the payloads.
    """
    on = PAYLOAD_KEY
    picked = ids.select(*on, *along)
    wide = changes.select(*on, "version", "lastUpdateTs", "deleted", "encoding", "content")

    def once(df: DataFrame) -> DataFrame:
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*on).orderBy("encoding", "content")))
        return ranked.where(F.col("_rank") == 1).drop("_rank")

    return once(wide.join(F.broadcast(picked) if small_ids else picked, on))


def position_order(prior: DataFrame) -> list[str]:
    """Columns that say which copy of a document comes first; the text itself when a frame has none."""
    return [c for c in POSITION_COLUMNS if c in prior.columns] or ["value"]


def first_copies(prior: DataFrame) -> DataFrame:
    """One row per ``(table, key)`` of a snapshot: the copy at the smallest position.

    Like :func:`newest_per_document`, at most one copy per key leaves a map task.
    """
    return _first_ranked(prior, [F.col(c) for c in position_order(prior)])


def repeated_documents(prior: DataFrame) -> DataFrame:
    """Keys that a snapshot holds more than once. Counts before the shuffle; reads no payload past the scan."""
    return (
        prior.groupBy(*DOCUMENT_KEY).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1).select(*DOCUMENT_KEY)
    )
