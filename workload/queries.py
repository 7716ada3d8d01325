"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import dates, identity, metadata, naming, payload
from tidemark.operators import combine, newest, ordering, tables
from tidemark.operators.balance import balanced_tasks
from tidemark.operators.ranges import key_ranges, number_by_range
from tidemark.operators.table_set import TableSet
from tidemark.plans.generate import generate_snapshot
from tidemark.plans.merge import merge_snapshot
from tidemark.session import scratch_path
from tidemark.sinks.change_log import append_change_log, to_change_rows
from tidemark.sinks.snapshot import copy_files, publish_snapshot, write_snapshot
from tidemark.sources import live_tables as live_sources
from tidemark.sources.change_log import filter_events, read_change_log, window_changes
from tidemark.sources.snapshot import (
    latest_snapshot,
    number_lines,
    scan_snapshot_keys,
    scan_snapshot_lines,
    snapshot_files,
)
from tidemark.sinks.quarantine import UNREADABLE_PAGE, read_quarantine
from tidemark.streaming.events import landed_events, parse_envelopes, parse_events, union_streams
from tidemark.streaming.ingest import ingest_changes
from workload import views
from workload.views import DAYS, NEW_TIME, NEXT_TIME, PRIOR_NAME, table

_SHORT = {
    "table": "tbl", "key": "k", "updateId": "uid", "lastUpdateTs": "last_ts", "pollDate": "poll_date",
}


def short(df: DataFrame, *columns: str) -> DataFrame:
    """Plain column names and text payloads for the comparison."""
    if "content" in df.columns:
        df = df.withColumn("content", payload.bytes_to_text(F.col("content")))
    return df.select(*[F.col(c).alias(_SHORT.get(c, c)) for c in (columns or df.columns)])


def _window(spark, sf):
    return window_changes(views.changes(spark, sf), DAYS)


def _live_set(spark, sf):
    return TableSet.of(views.live(spark, sf))


def _latest(spark, sf):
    return newest.latest_changes(views.changes(spark, sf), DAYS, _live_set(spark, sf))


def _documents(spark, sf):
    return combine.all_documents(_latest(spark, sf), views.prior(spark, sf))


# sources

def scan_changes(spark, sf):
    return short(read_change_log(spark, views.event_log(spark, sf)))


def live_tables_text(spark, sf):
    path = scratch_path(spark, "live")
    views.live(spark, sf).select("table").write.text(path)
    return short(live_sources.live_tables_text(spark, path))


def live_tables_catalog(spark, sf):
    path = scratch_path(spark, "catalog")
    table(spark, sf, "customer").selectExpr(
        """concat('{"name":"c', c_custkey, '","attributes":{"a":[1]}', CASE c_custkey % 5
             WHEN 0 THEN ',"availability":{"placement":"p","facade":false}' WHEN 1 THEN ',"availability":null'
             WHEN 2 THEN '' WHEN 3 THEN ',"availability":"{x}"' ELSE ',"availability":[]' END, '}') AS value"""
    ).write.text(path)
    return short(live_sources.live_tables_catalog(spark, path))


def _two_snapshots(spark, sf):
    root = scratch_path(spark, "root")
    for name, documents in (
        (PRIOR_NAME, views.customer_documents(spark, sf)),
        ("2024-01-20-00-00-00", views.supplier_documents(spark, sf)),
    ):
        write_snapshot(documents, f"{root}/{name}")
        publish_snapshot(spark, root, name)
    return root


def latest_snapshot_(spark, sf):
    root = _two_snapshots(spark, sf)
    name = latest_snapshot(spark, root)
    lines = scan_snapshot_lines(spark, root, name, position=False)
    return short(lines.groupBy("table").agg(F.count(F.lit(1)).alias("documents")).withColumn("name", F.lit(name)))


def publish_snapshot_(spark, sf):
    root = _two_snapshots(spark, sf)
    publish_snapshot(spark, root, PRIOR_NAME)
    name = latest_snapshot(spark, root)
    return short(scan_snapshot_keys(spark, root, name, position=False).select("table", "key", F.lit(name).alias("name")))


def snapshot_files_(spark, sf):
    files = snapshot_files(spark, views.shards(spark, sf), PRIOR_NAME)
    return short(files.groupBy("table").agg(F.count(F.lit(1)).alias("files"), F.min(F.col("bytes") > 0).alias("filled")))


def snapshot_file_count(spark, sf):
    return snapshot_files(spark, views.shards(spark, sf), PRIOR_NAME).agg(F.count(F.lit(1)).alias("files"))


def scan_lines(spark, sf):
    lines = number_lines(scan_snapshot_lines(spark, views.shards(spark, sf), PRIOR_NAME))
    return short(lines, "table", "line", "value")


def scan_keys(spark, sf):
    root = scratch_path(spark, "root")
    documents = table(spark, sf, "documents").selectExpr(
        "concat('doc:', lang) AS `table`",
        "string(doc_id) AS key",
        """to_json(named_struct('~deleted', false, '~id', string(doc_id), '~lastUpdateAt', '2024-01-01T00:00:00Z',
             '~table', 'somewhere:else', '~version', n_chars, 'text', text)) AS value""",
    )
    write_snapshot(documents, f"{root}/{PRIOR_NAME}")
    found = scan_snapshot_keys(spark, root, PRIOR_NAME, position=False)
    return short(found.select("table", "key", F.md5(F.get_json_object("value", "$.text")).alias("text_md5")))


def filter_condition(spark, sf):
    events = parse_events(spark.read.text(views.landing(spark, sf)))
    kept = filter_events(events, "version >= 10 and not deleted and `table` <> 't2'")
    return short(kept, "table", "key", "version", "lastUpdateTs")


# sinks

def append_log(spark, sf):
    path = scratch_path(spark, "log")
    both = views.changes(spark, sf)
    for half in ("version <= 15", "version > 15"):
        append_change_log(both.where(half), path)
    return short(read_change_log(spark, path), "pollDate", "table", "key", "updateId", "content")


def write_snapshot_(spark, sf):
    root = scratch_path(spark, "root")
    write_snapshot(views.customer_documents(spark, sf), f"{root}/{PRIOR_NAME}", documents_per_file=200)
    found = scan_snapshot_keys(spark, root, PRIOR_NAME, position=False)
    return short(found.select("table", "key", F.get_json_object("value", "$.body").alias("body")))


def copy_unmodified(spark, sf):
    root = scratch_path(spark, "root")
    write_snapshot(views.customer_documents(spark, sf), f"{root}/{PRIOR_NAME}", documents_per_file=200)
    unmodified = TableSet.of(tables.unmodified_tables(views.live(spark, sf), _window(spark, sf)))
    copy_files(snapshot_files(spark, root, PRIOR_NAME, unmodified), f"{root}/2024-01-20-00-00-00").count()
    found = scan_snapshot_keys(spark, root, "2024-01-20-00-00-00", position=False)
    return short(found.select("table", "key", F.get_json_object("value", "$.body").alias("body")))


def dropped(spark, sf):
    return short(tables.dropped_tables(views.live(spark, sf), _window(spark, sf)))


# projections and filters

def window_changes_(spark, sf):
    return short(window_changes(read_change_log(spark, views.event_log(spark, sf)), DAYS))


def updated(spark, sf):
    return short(tables.updated_tables(_window(spark, sf)))


def latest_ids(spark, sf):
    ids = newest.latest_change_ids(views.changes(spark, sf), DAYS, _live_set(spark, sf))
    return short(ids, "table", "key", "version", "updateId")


def payloads(spark, sf):
    live = _live_set(spark, sf)
    changes = views.changes(spark, sf)
    ids = newest.latest_change_ids(changes, DAYS, live)
    return short(newest.change_payloads(live.keep(window_changes(changes, DAYS)), ids), "table", "key", "updateId", "content")


def live_only(spark, sf):
    return short(newest.drop_tombstones(_latest(spark, sf)), "table", "key", "updateId", "content")


def table_status(spark, sf):
    # as a full outer join of the two name lists, which the flags of table_status_flags must agree with
    status = tables.table_presence(views.live(spark, sf), _window(spark, sf))
    action = tables.classify_tables(views.live(spark, sf), _window(spark, sf)).select("table", "action")
    return short(status.join(action, "table"))


def status_flags(spark, sf):
    return short(tables.table_status_flags(views.live(spark, sf), _window(spark, sf)))


def unmodified(spark, sf):
    return short(tables.unmodified_tables(views.live(spark, sf), _window(spark, sf)))


def to_rows(spark, sf):
    events = metadata.with_metadata(views.event_documents(spark, sf))
    stamp = F.timestamp_millis(F.col("lastUpdateTs"))
    return short(to_change_rows(events, received=stamp))


# joins and merges

def all_docs(spark, sf):
    return short(
        _documents(spark, sf), "table", "key", "has_change", "has_prior", "updateId", "deleted", "value"
    )


def changed(spark, sf):
    return short(combine.split_changed(_documents(spark, sf)), "table", "key", "updateId")


def only_prior(spark, sf):
    return short(combine.split_unchanged(_documents(spark, sf)), "table", "key", "value")


def unchanged(spark, sf):
    return short(combine.unchanged_documents(views.prior(spark, sf), _latest(spark, sf)), "table", "key", "value")


def of_live(spark, sf):
    return short(newest.changes_of_live_tables(_window(spark, sf), _live_set(spark, sf)), "table", "key", "updateId")


def fetch(spark, sf):
    lines = number_lines(scan_snapshot_lines(spark, views.shards(spark, sf), PRIOR_NAME))
    # every seventh line of each file is asked for, by its position
    places = lines.where(F.col("line") % 7 == 0).select("table", "file", "line")
    return short(combine.fetch_by_location(lines, places), "table", "line", "value")


def merge_counts(spark, sf):
    return combine.merge_counts(_documents(spark, sf))


def merged(spark, sf, **options):
    result = merge_snapshot(
        views.prior(spark, sf), views.changes(spark, sf), views.live(spark, sf), DAYS, **options
    )
    return short(result)


def merged_late(spark, sf):
    return merged(spark, sf, late=True)


def merged_all(spark, sf):
    return merged(spark, sf, copy_unmodified=False)


def merged_log(spark, sf):
    """From a change log on disk, partitioned as the ingest job leaves it."""
    log = read_change_log(spark, views.event_log(spark, sf))
    return short(merge_snapshot(views.prior(spark, sf), log, views.live(spark, sf), DAYS))


def merged_bulk(spark, sf, **options):
    result = merge_snapshot(
        views.bulk_prior(spark, sf), views.bulk_changes(spark, sf), views.bulk_live(spark, sf), views.BULK_DAYS, **options
    )
    return short(result)


def merged_bulk_late(spark, sf):
    return merged_bulk(spark, sf, late=True)


def merged_repeats(spark, sf):
    """A prior snapshot that holds most documents many times."""
    result = merge_snapshot(
        views.repeated_prior(spark, sf), views.changes(spark, sf), views.live(spark, sf), DAYS
    )
    return short(result)


def generated(spark, sf, **options):
    root, log = views.customer_root(spark, sf), views.document_log(spark, sf)
    out = scratch_path(spark, "root")
    generate_snapshot(spark, root, log, views.live(spark, sf), NEW_TIME, output_root=out, **options)
    found = scan_snapshot_keys(spark, out, latest_snapshot(spark, out), position=False)
    return short(found.select("table", "key", F.get_json_object("value", "$.body").alias("body")))


def generated_by_shuffle(spark, sf):
    """The key filter is kept far too small, so nearly every prior document takes the exact way through a shuffle."""
    return generated(spark, sf, filter_bytes=4096, regroup=True)


def generated_new(spark, sf):
    """Every changed table is new: the prior snapshot holds other tables only."""
    out = scratch_path(spark, "root")
    live = views.live(spark, sf).union(views.supplier_documents(spark, sf).select("table").distinct())
    generate_snapshot(spark, views.supplier_root(spark, sf), views.document_log(spark, sf), live, NEW_TIME, output_root=out)
    found = scan_snapshot_keys(spark, out, latest_snapshot(spark, out), position=False)
    return short(found.select("table", "key", F.get_json_object("value", "$.body").alias("body")))


def generated_hidden(spark, sf):
    """Tables whose folders Spark's readers pass over, in the plain layout, carried through two runs."""
    out, root = scratch_path(spark, "root"), views.hidden_root(spark, sf)
    live = views.hidden_documents(spark, sf).select("table").distinct()
    log = views.hidden_log(spark, sf)
    for when in (NEW_TIME, NEXT_TIME):
        generate_snapshot(spark, root, log, live, when, output_root=out, plain_names=True)
        root = out
    found = scan_snapshot_keys(spark, out, latest_snapshot(spark, out), position=False)
    return short(found.select("table", "key", F.get_json_object("value", "$.body").alias("body")))


def generated_all(spark, sf):
    return generated(spark, sf, copy_unmodified=False, regroup=False)


def generated_plain(spark, sf):
    return generated(spark, sf, plain_names=True, prior_unique=True)


# aggregations and order

def dedup_batch(spark, sf):
    return short(newest.newest_per_document(views.changes(spark, sf)), "table", "key", "updateId", "version", "content")


def latest(spark, sf):
    return short(_latest(spark, sf))


def latest_bulk(spark, sf):
    live = TableSet.of(views.bulk_live(spark, sf))
    return short(newest.latest_changes(views.bulk_changes(spark, sf), views.BULK_DAYS, live), "table", "key", "updateId")


def newest_turn(spark, sf):
    turns = table(spark, sf, "conversations").selectExpr(
        "role AS `table`", "string(conv_id) AS key", "turn AS version", "0L AS lastUpdateTs", "'' AS updateId", "text"
    )
    return newest.newest_per_document(turns).selectExpr("`table` AS tbl", "key AS k", "version", "md5(text) AS text_md5")


def dedup_snapshot(spark, sf):
    return short(newest.first_copies(views.repeated_prior(spark, sf)))


def repeated(spark, sf):
    return short(newest.repeated_documents(views.repeated_prior(spark, sf)))


def sort_changes(spark, sf):
    return short(ordering.sort_documents(views.changes(spark, sf), 8), "table", "key", "updateId")


def file_plan(spark, sf):
    return short(combine.snapshot_file_plan(views.repeated_prior(spark, sf), 100))


def union_changes(spark, sf):
    halves = [views.changes(spark, sf).where(f"deleted = {flag}") for flag in ("true", "false")]
    return short(newest.newest_per_document(union_streams(*halves)), "table", "key", "updateId")


def union_tables(spark, sf):
    names = live_sources.union_tables(views.live(spark, sf), views.bulk_live(spark, sf), views.live(spark, sf))
    return short(names)


# functions

def encode_table_name(spark, sf):
    names = table(spark, sf, "pages").select("page_id", "url")
    return names.select("page_id", naming.encode_table_name(F.col("url")).alias("encoded"))


def decode_table_name(spark, sf):
    names = table(spark, sf, "pages").selectExpr("page_id", "translate(url, '/', '~') AS url")
    return names.select("page_id", naming.decode_table_name(F.col("url")).alias("decoded"))


def extract_intrinsics(spark, sf):
    found = metadata.require_complete(metadata.with_metadata(views.event_documents(spark, sf)))
    return short(found, "event_id", *metadata.METADATA_COLUMNS)


def iso_to_millis(spark, sf):
    texts = table(spark, sf, "events").selectExpr(
        "event_id",
        """CASE event_id % 5
             WHEN 0 THEN date_format(timestamp(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
             WHEN 1 THEN date_format(timestamp(ts) + interval 2 hours, "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'")
             WHEN 2 THEN date_format(timestamp(ts) - interval 90 minutes, "yyyyMMdd'T'HHmmss.SSS'-0130'")
             WHEN 3 THEN date_format(timestamp(ts), "yyyy-MM-dd HH:mm")
             ELSE date_format(timestamp(ts), "yyyy-MM-dd'T'HH:mm'Z'") END AS text""",
    )
    return texts.select("event_id", metadata.iso_to_millis(F.col("text")).alias("millis"))


def invalid_documents(spark, sf):
    damaged = views.event_documents(spark, sf).selectExpr(
        "event_id",
        """CASE event_id % 6
             WHEN 0 THEN value
             WHEN 1 THEN replace(value, '"~id":"', '"~ID":"')
             WHEN 2 THEN regexp_replace(value, '"~version":([0-9]+)', '"~version":"$1"')
             WHEN 3 THEN regexp_replace(value, '"~version":([0-9]+)', '"~version":$1.75')
             WHEN 4 THEN regexp_replace(value, '"~deleted":(true|false)', '"~deleted":"$1"')
             ELSE concat('x', value) END AS value""",
    )
    return metadata.invalid_documents(metadata.with_metadata(damaged)).select("event_id")


def poll_date(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", dates.poll_date(F.col("ts").cast("timestamp")).alias("poll_date"))


def poll_dates(spark, sf):
    spans = table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").cast("timestamp").alias("first"), F.date_trunc("day", F.max("ts")).cast("timestamp").alias("last")
    )
    return spans.select("user_id", F.explode(dates.poll_dates(F.col("first"), F.col("last"))).alias("poll_date"))


def snapshot_name(spark, sf):
    named = table(spark, sf, "events").select("event_id", naming.snapshot_name(F.col("ts").cast("timestamp")).alias("name"))
    return named.withColumn("seconds", F.unix_seconds(naming.snapshot_time(F.col("name"))))


def file_suffix(spark, sf):
    return table(spark, sf, "documents").select("doc_id", naming.file_suffix(F.col("text")).alias("suffix"))


def update_id(spark, sf):
    ids = views.changes(spark, sf).select(
        F.col("updateId").alias("uid"),
        identity.update_id(F.col("table"), F.col("key"), F.col("version"), F.col("lastUpdateTs")).alias("id"),
    )
    return ids.select("uid", identity.parse_update_id(F.col("id")).alias("id"))


def text_payload(spark, sf):
    texts = table(spark, sf, "documents").select("doc_id", "text")
    packed = texts.select("doc_id", payload.text_to_bytes(F.col("text")).alias("packed"))
    return packed.select(
        "doc_id", F.octet_length("packed").cast("long").alias("bytes"), F.md5(payload.bytes_to_text(F.col("packed"))).alias("text_md5")
    )


def decode_payloads(spark, sf):
    """Payloads back to text, by their encoding code."""
    packed = table(spark, sf, "documents").select("doc_id", F.lit(0).alias("encoding"), payload.text_to_bytes(F.col("text")).alias("content"))
    return packed.select("doc_id", F.md5(payload.decode_payload(F.col("encoding"), F.col("content"))).alias("text_md5"))


def envelopes(spark, sf):
    events = parse_envelopes(spark.read.text(views.landing(spark, sf)))
    return events.select(
        F.col("eventKey").alias("event_key"),
        F.get_json_object("value", "$.body").alias("body"),
        F.get_json_object("value", "$.about.~id").alias("about"),
    )


# streaming

def stream_ingest(spark, sf):
    log = scratch_path(spark, "log")
    query = ingest_changes(landed_events(spark, views.landing(spark, sf)), log, scratch_path(spark, "checkpoint"), interval=None)
    query.awaitTermination()
    rows = read_change_log(spark, log)
    body = F.get_json_object(payload.bytes_to_text(F.col("content")), "$.body").alias("body")
    return short(rows.select("table", "key", "version", "lastUpdateTs", "deleted", body))


def stream_condition(spark, sf):
    """Two streams and a condition; compacted afterwards by the newest pick."""
    log = scratch_path(spark, "log")
    both = [
        landed_events(spark, views.landing(spark, sf), files_per_batch=2).where(F.length("value") % 2 == half)
        for half in (0, 1)
    ]
    query = ingest_changes(
        union_streams(*both), log, scratch_path(spark, "checkpoint"), condition="`table` <> 't1'", interval=None
    )
    query.awaitTermination()
    picked = newest.drop_tombstones(newest.newest_per_document(read_change_log(spark, log)))
    text = payload.decode_payload(F.col("encoding"), F.col("content"))
    return short(picked.select("table", "key", "version", F.get_json_object(text, "$.body").alias("body")))


def stream_dedup(spark, sf):
    """Several micro-batches, each leaving its newest change per document; the newest of those are those of all events."""
    log = scratch_path(spark, "log")
    events = landed_events(spark, views.landing(spark, sf), files_per_batch=1)
    ingest_changes(events, log, scratch_path(spark, "checkpoint"), interval=None).awaitTermination()
    rows = newest.newest_per_document(read_change_log(spark, log))
    return short(rows, "table", "key", "version", "lastUpdateTs", "deleted")


def stream_replay(spark, sf):
    """The whole input is delivered again, as after a crash between write and checkpoint: each change is logged once."""
    log = scratch_path(spark, "log")
    for checkpoint in ("lost", "kept"):
        events = landed_events(spark, views.landing(spark, sf))
        ingest_changes(events, log, scratch_path(spark, checkpoint), interval=None).awaitTermination()
    rows = read_change_log(spark, log)
    return short(rows.groupBy("table", "key", "version", "lastUpdateTs").agg(F.count(F.lit(1)).alias("times")))


def bad_pages(spark, sf):
    """Every tenth page is cut short; the pages that cannot be read are kept as they came."""
    events = parse_envelopes(spark.read.text(views.bad_landing(spark, sf)), on_invalid="keep")
    readable = F.col("eventKey").isNotNull()
    page = F.concat(F.lit("page "), F.floor(F.regexp_extract("value", views.FIRST_EVENT, 1).cast("long") / 50).cast("string"))
    return events.select(readable.alias("readable"), F.coalesce("eventKey", page).alias("name"))


def stream_quarantine(spark, sf):
    """Bad pages and documents are set aside, the others logged. All is delivered a second time, to the same two places."""
    log, aside = scratch_path(spark, "log"), scratch_path(spark, "quarantine")
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        events = landed_events(spark, views.mixed_landing(spark, sf))
        ingest_changes(events, log, checkpoint, interval=None, on_invalid="quarantine", quarantine=aside).awaitTermination()
    rejected = read_quarantine(spark, aside)
    page = F.concat(F.lit("page "), F.floor(F.regexp_extract("value", views.FIRST_EVENT, 1).cast("long") / 50).cast("string"))
    # the text is whole: what it tells is read from it
    told = F.coalesce(F.get_json_object("value", "$.body"), F.lit(""))
    name = F.when(F.col("reason") == UNREADABLE_PAGE, page).otherwise(F.col("eventKey"))
    logged = read_change_log(spark, log)
    body = F.get_json_object(payload.bytes_to_text(F.col("content")), "$.body")
    stored = logged.select(F.lit("stored").alias("outcome"), F.concat_ws("/", "table", "key", "version").alias("name"), body.alias("body"))
    return rejected.select(F.col("reason").alias("outcome"), name.alias("name"), told.alias("body")).unionByName(stored)


def snapshot_ranges(spark, sf):
    """Files of at most two hundred customers each, as their ranges of keys."""
    documents = views.customer_documents(spark, sf).selectExpr("`table`", "key")
    return short(key_ranges(documents, 200).drop("ordinal"), "table", "file_number", "first_key", "last_key", "documents")


def range_files(spark, sf):
    """Documents by language, each with the number of the file it is written to."""
    keys = table(spark, sf, "documents").selectExpr("lang AS `table`", "string(doc_id) AS key")
    return short(number_by_range(keys, 100), "table", "key", "file_number")


def balanced_files(spark, sf):
    """Documents as files that cannot be split, over tasks of fifty on average: what the fullest task may hold."""
    files = table(spark, sf, "documents").selectExpr("string(doc_id) AS path", "n_chars AS bytes")
    count, total, largest = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    tasks = -(-count // 50) or 1
    held = balanced_tasks(files, tasks, count, total).groupBy("task").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return held.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        F.coalesce(F.max("bytes") * tasks <= 2 * (total + tasks) + largest * tasks, F.lit(True)).alias("bytes_fit"),
        F.coalesce(F.max("files") * tasks <= 2 * count + 2 * tasks, F.lit(True)).alias("files_fit"),
    )


QUERIES = {
    "scan_changes": scan_changes,
    "live_tables_text": live_tables_text,
    "live_tables_catalog": live_tables_catalog,
    "latest_snapshot": latest_snapshot_,
    "publish_snapshot": publish_snapshot_,
    "snapshot_files": snapshot_files_,
    "snapshot_file_count": snapshot_file_count,
    "scan_snapshot_lines": scan_lines,
    "scan_snapshot_keys": scan_keys,
    "filter_condition": filter_condition,
    "append_change_log": append_log,
    "write_snapshot": write_snapshot_,
    "copy_unmodified": copy_unmodified,
    "dropped_tables": dropped,
    "window_changes": window_changes_,
    "updated_tables": updated,
    "latest_change_ids": latest_ids,
    "change_payloads": payloads,
    "drop_tombstones": live_only,
    "table_status": table_status,
    "table_status_flags": status_flags,
    "unmodified_tables": unmodified,
    "to_change_rows": to_rows,
    "all_documents": all_docs,
    "split_changed": changed,
    "split_unchanged": only_prior,
    "unchanged_documents": unchanged,
    "changes_of_live_tables": of_live,
    "fetch_by_location": fetch,
    "merge_counts": merge_counts,
    "merge_snapshot": merged,
    "merge_snapshot_late": merged_late,
    "merge_all_live": merged_all,
    "merge_partitioned_log": merged_log,
    "merge_bulk": merged_bulk,
    "merge_bulk_late": merged_bulk_late,
    "merge_repeated_prior": merged_repeats,
    "generate_snapshot": generated,
    "generate_snapshot_by_shuffle": generated_by_shuffle,
    "generate_new_tables": generated_new,
    "generate_hidden_names": generated_hidden,
    "generate_snapshot_all_live": generated_all,
    "generate_snapshot_plain_names": generated_plain,
    "dedup_batch": dedup_batch,
    "latest_changes": latest,
    "latest_changes_bulk": latest_bulk,
    "newest_turn": newest_turn,
    "dedup_snapshot": dedup_snapshot,
    "repeated_documents": repeated,
    "sort_changes": sort_changes,
    "snapshot_file_plan": file_plan,
    "snapshot_ranges": snapshot_ranges,
    "range_files": range_files,
    "balanced_files": balanced_files,
    "union_changes": union_changes,
    "union_tables": union_tables,
    "encode_table_name": encode_table_name,
    "decode_table_name": decode_table_name,
    "extract_intrinsics": extract_intrinsics,
    "iso_to_millis": iso_to_millis,
    "invalid_documents": invalid_documents,
    "poll_date": poll_date,
    "poll_dates": poll_dates,
    "snapshot_name": snapshot_name,
    "file_suffix": file_suffix,
    "update_id": update_id,
    "text_payload": text_payload,
    "decode_payloads": decode_payloads,
    "parse_envelopes": envelopes,
    "stream_ingest": stream_ingest,
    "union_streams": stream_condition,
    "stream_dedup": stream_dedup,
    "stream_replay": stream_replay,
    "bad_pages": bad_pages,
    "stream_quarantine": stream_quarantine,
}
