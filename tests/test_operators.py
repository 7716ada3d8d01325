"""Operators on hand-made rows, and the merge against a plain-Python model."""

import gzip

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from support import change, change_frame, document, model_merge, read_back, write_file

from tidemark.operators import combine, newest, tables
from tidemark.operators.table_set import TableSet
from tidemark.plans.merge import merge_snapshot
from tidemark.sinks.snapshot import copy_files, write_snapshot
from tidemark.sources import live_tables
from tidemark.sources.snapshot import number_lines, scan_snapshot_keys, scan_snapshot_lines, snapshot_files

NAME = "2018-01-07-00-00-00"


def names(spark, *tables_):
    return spark.createDataFrame([(t,) for t in tables_], "`table` string")


def prior_frame(spark, rows):
    """(table, key, value) in position order."""
    return spark.createDataFrame(
        [(t, k, f"f{i // 3:03}", i % 3 + 1, v) for i, (t, k, v) in enumerate(rows)],
        "`table` string, key string, file string, line int, value string",
    )


def triples(df):
    return sorted((r["table"], r["key"], r["value"]) for r in df.collect())


def test_newest_orders_by_version_then_time_then_id(spark):
    rows = [
        change("t", "a", 1, "20180107", ts=9), change("t", "a", 2, "20180107", ts=1, uid="u1"),
        change("t", "a", 2, "20180108", ts=5, uid="u0"), change("t", "a", 2, "20180107", ts=5, uid="u9"),
        change("u", "a", 1, "20180107", uid="other table"),
    ]
    got = newest.newest_per_document(change_frame(spark, rows)).collect()
    assert sorted(r["updateId"] for r in got) == ["other table", "u9"]


def test_a_delete_hides_older_versions_and_yields_to_newer_ones(spark):
    rows = [
        change("t", "dead", 1, "20180107"), change("t", "dead", 2, "20180107", deleted=True),
        change("t", "back", 1, "20180107", deleted=True), change("t", "back", 2, "20180107"),
    ]
    live = newest.drop_tombstones(newest.latest_changes(change_frame(spark, rows), ["20180107"]))
    assert [r["key"] for r in live.collect()] == ["back"]


@pytest.mark.parametrize("small", [False, True])
def test_payload_fetch_ignores_rows_written_twice(spark, small):
    rows = [change("t", "a", 1, "20180107", uid="x"), change("t", "a", 1, "20180107", uid="x"),
            change("t", "a", 1, "20180108", uid="x"), change("t", "b", 1, "20180107", uid="y")]
    log = change_frame(spark, rows)
    got = newest.change_payloads(log, newest.latest_change_ids(log), small).collect()
    assert sorted((r["key"], r["updateId"]) for r in got) == [("a", "x"), ("b", "y")]
    assert all(r["content"] is not None for r in got)


def test_first_copies_and_repeats(spark):
    prior = prior_frame(spark, [("t", "a", "1"), ("t", "b", "2"), ("t", "a", "3"), ("u", "a", "4"), ("t", "a", "5")])
    assert triples(newest.first_copies(prior)) == [("t", "a", "1"), ("t", "b", "2"), ("u", "a", "4")]
    assert [tuple(r) for r in newest.repeated_documents(prior).collect()] == [("t", "a")]


def test_classification(spark):
    live = names(spark, "merge", "copy", "merge", "empty")
    changes = change_frame(spark, [change("merge", "a", 1, "20180107"), change("gone", "a", 1, "20180107")])
    got = {r["table"]: (r["live"], r["updated"], r["action"]) for r in tables.classify_tables(live, changes).collect()}
    assert got == {
        "merge": (True, True, "merge"), "copy": (True, False, "copy"), "empty": (True, False, "copy"),
        "gone": (False, True, "drop"),
    }
    every = tables.classify_tables(live, changes, copy_unmodified=False).where("action = 'merge'")
    assert sorted(r["table"] for r in every.collect()) == ["copy", "empty", "merge"]
    assert [r[0] for r in tables.dropped_tables(live, changes).collect()] == ["gone"]
    assert sorted(r[0] for r in tables.unmodified_tables(live, changes).collect()) == ["copy", "empty"]


@pytest.mark.parametrize("literal, size", [(10, 0), (1, 1 << 20), (1, 0)])
def test_table_sets_of_every_form(spark, literal, size):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "`table` string, n int")
    chosen = TableSet.of(names(spark, "a", "b", "a", "z"), literal, size)
    assert (chosen.names is not None, chosen.broadcast) == (literal == 10, literal == 1 and size > 0)
    assert sorted(r["n"] for r in chosen.keep(frame).collect()) == [1, 2]
    assert 3 in [r["n"] for r in chosen.drop(frame).collect()]


def test_empty_table_set(spark):
    nothing = TableSet.of(names(spark, "x").where("false"))
    frame = names(spark, "a", "b")
    assert nothing.is_empty() and nothing.keep(frame).count() == 0 and nothing.drop(frame).count() == 2


def test_counts_and_split(spark):
    changes = newest.newest_per_document(change_frame(spark, [change("t", "a", 1, "20180107"), change("t", "n", 1, "20180107")]))
    documents = combine.all_documents(changes, prior_frame(spark, [("t", "a", "1"), ("t", "b", "2")]))
    assert tuple(combine.merge_counts(documents).first()) == (2, 1)
    assert sorted(r["key"] for r in combine.split_changed(documents).collect()) == ["a", "n"]
    assert [r["key"] for r in combine.split_unchanged(documents).collect()] == ["b"]


def test_file_plan(spark):
    rows = [("t", str(i), "v") for i in range(7)] + [("u", "1", "v")]
    plan = {r["table"]: (r["documents"], r["files"]) for r in combine.snapshot_file_plan(prior_frame(spark, rows), 3).collect()}
    assert plan == {"t": (7, 3), "u": (1, 1)}


DAY = st.sampled_from(["20180106", "20180107", "20180108", "20180109"])
TABLE = st.sampled_from(["a", "b:c", "d", "e"])
KEY = st.sampled_from(["k1", "k2", "k3", "k4"])
CHANGE = st.builds(
    lambda t, k, v, ts, d, day, n: change(t, k, v, day, f"n{n}", ts, f"u{n}", d),
    TABLE, KEY, st.integers(0, 3), st.integers(0, 2), st.booleans(), DAY, st.integers(0, 10**6),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    changes=st.lists(CHANGE, max_size=25, unique_by=lambda c: c[0]),
    prior=st.lists(st.tuples(TABLE, KEY, st.sampled_from(["v1", "v2", "v3"])), max_size=15),
    live=st.sets(TABLE),
    copy=st.booleans(),
    late=st.booleans(),
)
def test_merge_agrees_with_the_model(spark, changes, prior, live, copy, late):
    days = ["20180107", "20180108"]
    got = merge_snapshot(
        prior_frame(spark, prior), change_frame(spark, changes), names(spark, *sorted(live)), days, copy, late
    )
    assert triples(got) == model_merge(prior, changes, live, days, copy)


def test_two_windows_equal_one(spark):
    changes = [
        change("t", "a", 1, "20180107"), change("t", "a", 2, "20180108"), change("t", "b", 1, "20180107"),
        change("t", "b", 2, "20180108", deleted=True), change("t", "c", 1, "20180107", deleted=True),
        change("t", "c", 2, "20180108"), change("t", "d", 1, "20180108"),
    ]
    prior = [("t", "c", "old"), ("t", "keep", "old"), ("u", "x", "other")]
    log, live = change_frame(spark, changes), names(spark, "t", "u")
    first = merge_snapshot(prior_frame(spark, prior), log, live, ["20180107"])
    second = merge_snapshot(first.select("table", "key", "value"), log, live, ["20180108"])
    assert triples(second) == triples(merge_snapshot(prior_frame(spark, prior), log, live, ["20180107", "20180108"]))


def test_live_tables(spark, tmp_path):
    (tmp_path / "live.txt").write_text("a:b\n\nc\r\nd")
    assert [r[0] for r in live_tables.live_tables_text(spark, str(tmp_path / "live.txt")).collect()] == ["a:b", "c", "d"]
    (tmp_path / "catalog.json").write_text(
        '{"name":"yes","availability":{"placement":"x"},"other":1}\n{"name":"null","availability":null}\n'
        '{"name":"none"}\n{"name":"text","availability":"{}"}\n{"name":"list","availability":[1]}\n'
        '{"name":"flag","availability":true}\n'
    )
    catalog = live_tables.live_tables_catalog(spark, str(tmp_path / "catalog.json"))
    assert sorted(r[0] for r in catalog.collect()) == ["list", "yes"]


def test_snapshot_scan_positions(spark, tmp_path):
    write_file(tmp_path, NAME, "a:b", "x-0.json", ["l1", "", "l2"], trailing_newline=False)
    write_file(tmp_path, NAME, "a:b", "x-1.json.gz", ["", "m1", "m2", ""])
    write_file(tmp_path, NAME, "other", "y.json", ["n1"])
    (tmp_path / NAME / "a~b" / "deeper").mkdir()
    (tmp_path / NAME / "a~b" / "deeper" / "z.json").write_text("not listed")
    (tmp_path / NAME / "_SUCCESS").write_text("")
    chosen = TableSet.of(names(spark, "a:b", "missing"))
    lines = number_lines(scan_snapshot_lines(spark, str(tmp_path), NAME, chosen))
    got = sorted((r["table"], r["file"], r["line"], r["value"]) for r in lines.collect())
    assert got == [
        ("a:b", "x-0.json", 1, "l1"), ("a:b", "x-0.json", 2, "l2"),
        ("a:b", "x-1.json.gz", 1, "m1"), ("a:b", "x-1.json.gz", 2, "m2"),
    ]
    files = snapshot_files(spark, str(tmp_path), NAME).collect()
    assert sorted((r["table"], r["file"]) for r in files) == [("a:b", "x-0.json"), ("a:b", "x-1.json.gz"), ("other", "y.json")]
    assert scan_snapshot_lines(spark, str(tmp_path), "2000-01-01-00-00-00").count() == 0
    assert snapshot_files(spark, str(tmp_path), "2000-01-01-00-00-00").count() == 0

    wanted = lines.select("table", "file", "line").where("line = 2")
    assert sorted(r["value"] for r in combine.fetch_by_location(lines, wanted).collect()) == ["l2", "m2"]
    beyond = wanted.withColumn("line", F.lit(9))
    assert [r["value"] for r in combine.fetch_by_location(lines, beyond, strict=False).collect()] == [None, None]
    with pytest.raises(Exception, match="no such line"):
        combine.fetch_by_location(lines, beyond).collect()


def test_line_numbers_of_a_split_file(spark, tmp_path):
    lines = [f"line {i:06}" if i % 7 else "" for i in range(20000)]
    write_file(tmp_path, NAME, "big", "b.json", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scanned = scan_snapshot_lines(spark, str(tmp_path), NAME)
        assert scanned.rdd.getNumPartitions() > 5
        got = [(r["line"], r["value"]) for r in number_lines(scanned).orderBy("line").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i + 1, text) for i, text in enumerate(t for t in lines if t)]


def test_written_snapshot_is_sorted_sized_and_readable(spark, tmp_path):
    rows = [("big:one", f"{i:05}", document("big:one", f"{i:05}", text="ü")) for i in range(1000)]
    rows += [("a+b %c:d", "k", document("a+b %c:d", "k")), ("tiny", "k", document("tiny", "k"))]
    frame = spark.createDataFrame(rows, "`table` string, key string, value string")
    write_snapshot(frame, str(tmp_path / NAME), documents_per_file=100)
    found = scan_snapshot_keys(spark, str(tmp_path), NAME)
    assert triples(found) == sorted(rows)
    files = sorted((tmp_path / NAME / "table=big~one").glob("*.gz"))
    assert len(files) >= 10
    for file in files:
        lines = gzip.decompress(file.read_bytes()).decode("utf-8").splitlines()
        assert len(lines) <= 100 and lines
    # copying keeps odd names intact
    copied = copy_files(snapshot_files(spark, str(tmp_path), NAME), str(tmp_path / "2018-01-08-00-00-00"))
    assert copied.count() == snapshot_files(spark, str(tmp_path), NAME).count()
    assert triples(scan_snapshot_keys(spark, str(tmp_path), "2018-01-08-00-00-00")) == sorted(rows)


def test_tables_that_share_a_directory_are_not_doubled(spark, tmp_path):
    rows = [("a:b", "1", "x"), ("a~b", "2", "y")]
    write_snapshot(spark.createDataFrame(rows, "`table` string, key string, value string"), str(tmp_path / NAME))
    assert read_back(tmp_path, NAME) == {"a:b": ["x", "y"]}
