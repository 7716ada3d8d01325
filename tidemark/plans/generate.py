"""The compaction job: read the latest snapshot and the change log, write and publish the next snapshot."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.dates import check_snapshot_order, window_days
from tidemark.functions.naming import encode_table_name, format_snapshot_name, parse_snapshot_name
from tidemark.functions.payload import decode_payload
from tidemark.operators.combine import unchanged_documents
from tidemark.operators.key_filter import FILTER_BYTES, KeyFilter
from tidemark.operators.newest import (
    PAYLOAD_KEY,
    change_payloads,
    drop_tombstones,
    first_copies,
    latest_change_ids,
    repeated_documents,
)
from tidemark.operators.ranges import number_by_range
from tidemark.operators.table_set import TableSet
from tidemark.operators.tables import classify_tables
from tidemark.schema import DOCUMENT_KEY, DOCUMENTS_PER_FILE
from tidemark.session import scratch_path, stage
from tidemark.sinks.manifest import next_manifest, read_manifest, write_manifest
from tidemark.sinks.moves import move_files
from tidemark.sinks.snapshot import copy_files, name_files, publish_snapshot, write_snapshot
from tidemark.sources import storage
from tidemark.sources.change_log import read_change_log
from tidemark.sources.snapshot import Snapshot, latest_snapshot, snapshot_files


@dataclass
class SnapshotReport:
    """What a compaction did.

    ``updated`` documents were written from changes, ``deleted`` ones have a delete as newest change, ``carried`` ones come from merged tables of
    the previous snapshot; all are counted by the jobs that write them.
    ``dropped`` lists, sorted, tables with changes that are no longer live; it is computed from the inputs when it is read.
    """

    name: str
    days: list[str]
    updated: int
    deleted: int
    carried: int
    copied_files: int
    regrouped: bool
    dropped: DataFrame = field(repr=False)


def generate_snapshot(
    spark: SparkSession,
    root: str,
    change_log: str,
    live: DataFrame,
    when: datetime,
    output_root: str | None = None,
    copy_unmodified: bool = True,
    documents_per_file: int = DOCUMENTS_PER_FILE,
    lookback_days: int = 0,
    strict: bool = True,
    regroup: bool = False,
    prior_unique: bool = False,
    plain_names: bool = False,
    filter_bytes: int = FILTER_BYTES,
) -> SnapshotReport:
    """Write the snapshot for time ``when`` below ``output_root`` (default: ``root``) and point ``_LATEST`` at it.

    The pointer moves only after every file is written, so a failed run leaves readers on the old snapshot and
    can simply be run again.

    The changed keys are picked on narrow columns and written to the shared scratch area. A filter of at most
    ``filter_bytes`` over them, and over the keys that the prior snapshot holds more than once, tells which prior documents
    cannot be concerned: the task that reads those writes them, and only the others are set aside, shuffled and compared
    exactly. Each prior text is read once; only tables that the prior snapshot's manifest does not call unique are
    read once more before, to find repeated keys. The same way, changes that were not picked never leave their scan with their payload.
    ``regroup`` sorts the carried-over documents into full-sized files too; else they are written as they are read.
    ``prior_unique`` vouches that no merged table holds a document twice, whatever the manifest says.
    ``plain_names`` renames the finished files to ``<table>/<table>-<md5 of the first key>.gz``; else they are
    ``table=<table>/part-….gz``.
    """
    output_root = output_root or root
    prior_name = latest_snapshot(spark, root)
    prior_time = parse_snapshot_name(prior_name)
    check_snapshot_order(prior_time, when)
    name = format_snapshot_name(when)
    target = f"{output_root.rstrip('/')}/{name}"
    days = window_days(prior_time, when, lookback_days)

    # one listing of the log serves the whole run: batches that land meanwhile wait for the next window
    window = read_change_log(spark, change_log, days)
    work = scratch_path(spark, "compaction")
    try:
        status = stage(classify_tables(live, window, copy_unmodified), "status", work)
        prior = Snapshot(spark, root, prior_name, work)
        known = read_manifest(spark, root, prior_name)
        report = _write(prior, known, target, window, status, work, documents_per_file, strict, regroup, prior_unique, filter_bytes, plain_names)
        if plain_names:
            name_files(snapshot_files(spark, output_root, name, work=work), target, work=work)
        write_manifest(next_manifest(status, known), output_root, name)
    finally:
        storage.delete(spark, work)
    publish_snapshot(spark, output_root, name)
    dropped = classify_tables(live, window, copy_unmodified).where(F.col("action") == "drop").select("table").orderBy("table")
    return SnapshotReport(name=name, days=days, dropped=dropped, **report)


def _write(
    prior: Snapshot, known, target, window, status, work, documents_per_file, strict, regroup, prior_unique, filter_bytes, plain_names
) -> dict:
    sets = TableSet.by_action(status)
    merged, copied = sets["merge"], sets["copy"]

    # which change of each document counts: decided once, on narrow columns
    picks = Observation("picks")
    ids = latest_change_ids(window, live=merged)
    ids = stage(ids.observe(picks, F.count(F.lit(1)).alias("changed"), F.count_if(F.col("deleted")).alias("deleted")), "changed", work)
    totals = picks.get

    # changed documents
    live_ids = drop_tombstones(ids)
    # the range of keys, and so the file, of each document: found on the ids, it comes along with the payload
    numbered = stage(number_by_range(live_ids.select(*PAYLOAD_KEY), documents_per_file, work), "numbered", work)
    tasks = (numbered.agg(F.max("task")).first()[0] or 0) + 1
    picked = KeyFilter(live_ids, PAYLOAD_KEY, filter_bytes)
    newest = change_payloads(merged.keep(window).where(picked.maybe()), numbered, along=("task",))
    text = decode_payload(F.col("encoding"), F.col("content"))
    write_snapshot(newest.select("table", "key", text.alias("value"), "task"), target, documents_per_file, tasks)

    # documents carried over
    regrouped, carried = False, 0
    if not merged.is_empty():
        if regroup:
            documents = _carried(prior, merged, ids, work, strict, prior_unique, filter_bytes, known)
            carried = _write_regrouped(documents, target, documents_per_file, work)
            regrouped = carried > 0
        else:
            repeated = _repeated(prior, merged, known, work, strict, prior_unique)
            carried = _write_carried(prior, merged, ids, repeated, target, work, documents_per_file, strict, filter_bytes)

    # unmodified tables
    copied_files = 0
    if not copied.is_empty():
        copied_files = copy_files(prior.files(copied), target, plain=plain_names).count()

    return {
        "updated": totals["changed"] - totals["deleted"],
        "deleted": totals["deleted"],
        "carried": carried,
        "copied_files": copied_files,
        "regrouped": regrouped,
    }


def _repeated(prior: Snapshot, tables: TableSet, known: DataFrame | None, work: str, strict: bool, prior_unique: bool) -> DataFrame | None:
    """Keys that a merged table holds more than once, or None if the manifest (or the caller) says that there are none."""
    if prior_unique:
        return None
    doubtful = tables
    if known is not None:
        certified = known.where("unique").select("table")
        doubtful = TableSet.of(stage(tables.frame.select("table").distinct().join(certified, "table", "left_anti"), "doubtful", work))
    if doubtful.is_empty():
        return None
    keys = prior.documents(doubtful, position=False, strict=strict).select(*DOCUMENT_KEY)
    return stage(repeated_documents(keys), "repeated", work)


def _concerned(ids: DataFrame, repeated: DataFrame | None, filter_bytes: int) -> KeyFilter:
    """Tells the documents that may have a change or another copy."""
    keys = ids.select(*DOCUMENT_KEY)
    return KeyFilter(keys if repeated is None else keys.unionByName(repeated), DOCUMENT_KEY, filter_bytes)


def _carried(
    prior: Snapshot, tables: TableSet, ids: DataFrame, work: str, strict: bool, prior_unique: bool, filter_bytes: int, known: DataFrame | None = None
) -> DataFrame:
    """Prior documents without any change, each once. Those that the key filter lets go are never shuffled."""
    columns = [*DOCUMENT_KEY, "value"]
    repeated = _repeated(prior, tables, known, work, strict, prior_unique)
    concerned = _concerned(ids, repeated, filter_bytes)
    single = prior.documents(tables, position=False, strict=strict).where(~concerned.maybe())
    copies = prior.documents(tables, position=repeated is not None, strict=strict).where(concerned.maybe())
    exact = unchanged_documents(copies if repeated is None else first_copies(copies), ids)
    return single.select(*columns).unionByName(exact.select(*columns))


# A document that is set aside for the exact comparison, as a line of JSON.
_ASIDE = "table string, key string, value string, file string, block long, seq long"


def _write_carried(prior: Snapshot, tables: TableSet, ids: DataFrame, repeated: DataFrame | None, target: str, work: str, documents_per_file: int, strict: bool, filter_bytes: int) -> int:
    """Append the prior documents without any change, each once; returns their number.

    One pass over the text writes both kinds: those that cannot be concerned as files of the snapshot, which only have to be moved to
    it, and the others aside. These, few of them, are read back, compared exactly and written.
    """
    spark = ids.sparkSession
    concerned = _concerned(ids, repeated, filter_bytes)
    documents = prior.documents(tables, strict=strict).withColumn("aside", concerned.maybe())
    line = F.when(F.col("aside"), F.to_json(F.struct("table", "key", "value", "file", "block", "seq"))).otherwise(F.col("value"))
    written, rest = Observation("carried"), Observation("compared")
    split = documents.observe(written, F.count_if(~F.col("aside")).alias("documents"))
    folder = f"{work}/carried"
    (
        split.select("aside", encode_table_name(F.col("table")).alias("table"), line.alias("value"))
        .write.mode("overwrite")
        .partitionBy("aside", "table")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", documents_per_file)
        .text(folder)
    )
    move_files(spark, f"{folder}/aside=false", target)
    if not storage.exists(spark, f"{folder}/aside=true"):
        return written.get["documents"]
    # the folder's name is the encoded one; the line has the table's own
    copies = spark.read.schema(_ASIDE).option("recursiveFileLookup", "true").json(f"{folder}/aside=true")
    exact = unchanged_documents(copies if repeated is None else first_copies(copies), ids)
    exact = exact.observe(rest, F.count(F.lit(1)).alias("documents"))
    write_snapshot(exact.select(*DOCUMENT_KEY, "value"), target, documents_per_file, grouped=False, mode="append")
    return written.get["documents"] + rest.get["documents"]


def _write_regrouped(carried: DataFrame, target: str, documents_per_file: int, work: str) -> int:
    """Append the carried documents in files of the target size, each a range of keys; returns their number."""
    written = Observation("regrouped")
    documents = stage(carried.observe(written, F.count(F.lit(1)).alias("documents")), "regroup", work)
    if not written.get["documents"]:
        return 0
    # a folder of its own: that of the changes is still read
    write_snapshot(documents, target, documents_per_file, mode="append", work=f"{work}/regrouped")
    return written.get["documents"]
