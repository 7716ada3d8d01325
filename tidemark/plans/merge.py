"""The merge of a change log into a snapshot, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.payload import decode_payload
from tidemark.operators.combine import all_documents
from tidemark.operators.key_filter import KeyFilter
from tidemark.operators.newest import PAYLOAD_KEY, change_payloads, first_copies, latest_change_ids, latest_changes
from tidemark.operators.table_set import TableSet
from tidemark.operators.tables import classify_tables
from tidemark.session import stage
from tidemark.sources.change_log import window_changes


def merge_documents(newest: DataFrame, prior: DataFrame) -> DataFrame:
    """``table, key, value, origin`` of the next snapshot from newest changes and first copies.

    A document with a change takes the change, or goes if that is a delete; any other keeps its prior text.
    """
    documents = all_documents(
        newest.select("table", "key", "deleted", "encoding", "content"), prior.select("table", "key", "value")
    )
    kept = documents.where(~F.col("has_change") | ~F.col("deleted"))
    text = decode_payload(F.col("encoding"), F.col("content"))
    return kept.select(
        "table",
        "key",
        F.when(F.col("has_change"), text).otherwise(F.col("value")).alias("value"),
        F.when(F.col("has_change"), "update").otherwise("prior").alias("origin"),
    )


def merge_snapshot(
    prior: DataFrame,
    changes: DataFrame,
    live: DataFrame,
    days: list[str],
    copy_unmodified: bool = True,
    late: bool = False,
) -> DataFrame:
    """The next snapshot's documents: ``table, key, value, origin`` with origin ``update``, ``prior`` or ``copy``.

    ``prior`` has ``table, key, value`` and position columns; ``changes`` is a change log. Changes and prior are
    each shuffled once, by ``(table, key)``, with at most one row per document and map task; the join reuses that
    partitioning. Tables without changes pass through unshuffled unless ``copy_unmodified`` is off. ``late``
    picks the newest changes on narrow columns first (and runs that at once); of the log only rows that a filter over
    the picked ones lets through are shuffled with their payload.
    """
    window = window_changes(changes, days)
    if copy_unmodified:
        sets = TableSet.by_action(classify_tables(live, window))
        merged = sets["merge"]
    else:
        merged = TableSet.of(live)
    if late:
        ids = stage(latest_change_ids(window, live=merged), "changed")
        picked = KeyFilter(ids, PAYLOAD_KEY)
        newest = change_payloads(merged.keep(window).where(picked.maybe()), ids)
    else:
        newest = latest_changes(window, live=merged)
    result = merge_documents(newest, first_copies(merged.keep(prior)))
    if not copy_unmodified:
        return result
    copied = sets["copy"].keep(prior)
    return result.unionByName(copied.select("table", "key", "value", F.lit("copy").alias("origin")))
