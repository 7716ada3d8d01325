"""The ingest job: batches, replays, restarts."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from support import document

from tidemark.operators.newest import newest_per_document
from tidemark.sinks import change_log as sink
from tidemark.sources.change_log import read_change_log
from tidemark.streaming import ingest
from tidemark.streaming.events import landed_events, parse_envelopes, parse_events, union_streams


def land(folder, name, *documents):
    """One file of one poll page; ``documents`` are JSON texts."""
    folder.mkdir(parents=True, exist_ok=True)
    page = "[" + ",".join(
        '{"skipped":{"a":[1,{"b":2}]},"eventKey":"e%d","content":%s,"tags":["x"]}' % (i, d) for i, d in enumerate(documents)
    ) + "]"
    (folder / name).write_text(page + "\n\n[]\n")


def run(spark, folder, log, checkpoint, **options):
    query = ingest.ingest_changes(landed_events(spark, str(folder), 1), str(log), str(checkpoint), interval=None, **options)
    query.awaitTermination()
    return query


def logged(spark, log):
    rows = read_change_log(spark, str(log)).collect()
    return sorted((r["table"], r["key"], r["version"], r["deleted"], None if r["content"] is None else bytes(r["content"]).decode()) for r in rows)


def test_envelopes(spark, tmp_path):
    land(tmp_path / "in", "p.json", '{"~id": "a", "x": [1, 2.50, null], "s": "a\\"b"}', '{"~id":"b"}')
    rows = parse_envelopes(spark.read.text(str(tmp_path / "in"))).collect()
    assert [(r["eventKey"], json.loads(r["value"])) for r in rows] == [
        ("e0", {"~id": "a", "x": [1, 2.5, None], "s": 'a"b'}), ("e1", {"~id": "b"}),
    ]
    assert " " not in rows[0]["value"]


def test_each_batch_keeps_the_newest_and_appends(spark, tmp_path):
    source, log = tmp_path / "in", tmp_path / "log"
    started = datetime.now(timezone.utc).strftime("%Y%m%d")
    land(source, "1.json", document("t:1", "a", 1), document("t:1", "a", 3), document("t:1", "a", 2), document("t:2", "a", 1))
    run(spark, source, log, tmp_path / "cp")
    assert logged(spark, log) == [("t:1", "a", 3, False, document("t:1", "a", 3)), ("t:2", "a", 1, False, document("t:2", "a", 1))]
    land(source, "2.json", document("t:1", "a", 4, deleted=True))
    land(source, "3.json", document("t:1", "b", 1))
    run(spark, source, log, tmp_path / "cp")
    assert logged(spark, log) == [
        ("t:1", "a", 3, False, document("t:1", "a", 3)), ("t:1", "a", 4, True, None),
        ("t:1", "b", 1, False, document("t:1", "b", 1)), ("t:2", "a", 1, False, document("t:2", "a", 1)),
    ]
    days = {r[0] for r in read_change_log(spark, str(log)).select("pollDate").distinct().collect()}
    assert {started, datetime.now(timezone.utc).strftime("%Y%m%d")} >= days and days
    assert (log / f"pollDate={max(days)}" / "table=t%3A1").is_dir()


def test_condition_and_invalid_documents(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "1.json", document("t", "a", 1), document("u", "b", 1), '{"~id":"broken"}')
    run(spark, source, tmp_path / "log", tmp_path / "cp", condition="`table` = 't'", on_invalid="drop")
    assert [r[:2] for r in logged(spark, tmp_path / "log")] == [("t", "a")]
    with pytest.raises(Exception, match="lacks a required attribute"):
        run(spark, source, tmp_path / "log2", tmp_path / "cp2")
    with pytest.raises(ValueError):
        parse_events(spark.read.text(str(source)), on_invalid="ignore")


@pytest.mark.parametrize("bad", ['[{"eventKey":"e1","content":{"~id"', "not json", '"text"'])
def test_unreadable_pages_stop_the_stream_or_are_kept(spark, tmp_path, bad):
    from tidemark.streaming.events import parse_envelopes

    pages = spark.createDataFrame([(bad,), ("[]",), (" ",), ('[{"eventKey":"e2","content":{"a":1}}]',)], "value string")
    kept = parse_envelopes(pages, "keep").collect()
    assert sorted((r["eventKey"] or "", r["value"]) for r in kept) == [("", bad), ("e2", '{"a":1}')]
    assert [r["eventKey"] for r in parse_envelopes(pages, "drop").collect()] == ["e2"]
    with pytest.raises(Exception, match="unreadable page"):
        parse_envelopes(pages).collect()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "page.txt").write_text(bad + "\n")
    with pytest.raises(Exception, match="unreadable page"):
        run(spark, tmp_path / "in", tmp_path / "log", tmp_path / "cp")


@pytest.mark.parametrize("moment", ["before", "half", "after"])
def test_a_crashed_batch_is_replayed_without_doubling(spark, tmp_path, monkeypatch, moment):
    source, log, checkpoint = tmp_path / "in", tmp_path / "log", tmp_path / "cp"
    documents = [document("t", f"k{i}", 1) for i in range(20)]
    land(source, "1.json", *documents)
    real = sink.append_change_log

    def crash(rows, path, partitions):
        if moment == "half":
            real(rows.where("key < 'k15'"), path, partitions)
        elif moment == "after":
            real(rows, path, partitions)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest, "append_change_log", crash)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, source, log, checkpoint)
    monkeypatch.setattr(ingest, "append_change_log", real)
    land(source, "2.json", document("t", "k0", 2))
    run(spark, source, log, checkpoint)
    got = logged(spark, log)
    assert sorted(r[1:3] for r in got) == sorted([(f"k{i}", 1) for i in range(20)] + [("k0", 2)])
    # the replay kept the day of the first attempt
    assert read_change_log(spark, str(log)).select("updateId").distinct().count() == 21


def test_redelivery_leaves_the_newest_pick_unchanged(spark, tmp_path):
    source, log = tmp_path / "in", tmp_path / "log"
    land(source, "1.json", document("t", "a", 1), document("t", "b", 1))
    land(source, "2.json", document("t", "a", 1), document("t", "b", 2))
    run(spark, source, log, tmp_path / "cp")
    newest = newest_per_document(read_change_log(spark, str(log))).collect()
    assert sorted((r["key"], r["version"]) for r in newest) == [("a", 1), ("b", 2)]


def test_stream_equals_batch(spark, tmp_path):
    for n in range(2):
        land(tmp_path / f"in{n}", "1.json", *[document("t", f"k{i % 5}", i * (n + 1), text=str(i)) for i in range(20)])
    both = [landed_events(spark, str(tmp_path / f"in{n}")) for n in range(2)]
    query = ingest.ingest_changes(union_streams(*both), str(tmp_path / "log"), str(tmp_path / "cp"), interval=None)
    query.awaitTermination()
    lines = union_streams(*[spark.read.text(str(tmp_path / f"in{n}")) for n in range(2)])
    twin = ingest.change_rows(parse_events(lines).withColumn("pollDate", F.lit("x")))
    columns = ["updateId", "table", "key", "version", "deleted", "content"]
    got = read_change_log(spark, str(tmp_path / "log")).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, twin.select(*columns).collect()))


def aside(spark, folder):
    from tidemark.sinks.quarantine import read_quarantine

    return sorted((r["eventKey"] or "", r["value"], r["reason"], r["batch"]) for r in read_quarantine(spark, str(folder)).collect())


BROKEN = '{"~id":"broken","text":"kept"}'


def test_what_cannot_be_stored_goes_to_the_quarantine_with_its_text(spark, tmp_path):
    source, log, away = tmp_path / "in", tmp_path / "log", tmp_path / "away"
    land(source, "1.json", document("t", "a", 1), BROKEN, document("u", "b", 1))
    (source / "2.json").write_text("no page\n")
    assert aside(spark, away) == []
    run(spark, source, log, tmp_path / "cp", on_invalid="quarantine", quarantine=str(away), condition="`table` = 't'")
    assert [r[:2] for r in logged(spark, log)] == [("t", "a")]
    found = [r[:3] for r in aside(spark, away)]
    assert found == [("", "no page", "unreadable page"), ("e1", BROKEN, "lacks ~table, ~version, ~lastUpdateAt, ~deleted")]


@pytest.mark.parametrize("moment", ["quarantine", "staged", "committed"])
def test_a_crash_between_the_two_sinks_adds_nothing_twice(spark, tmp_path, monkeypatch, moment):
    from tidemark.sinks.batches import BatchCommit

    source, log, away, checkpoint = tmp_path / "in", tmp_path / "log", tmp_path / "away", tmp_path / "cp"
    options = {"on_invalid": "quarantine", "quarantine": str(away)}
    land(source, "0.json", document("t", "k", 0), BROKEN)
    run(spark, source, log, checkpoint, **options)
    land(source, "1.json", BROKEN, *[document("t", f"k{i}", 1) for i in range(10)])

    def lost(*_):
        raise RuntimeError("executor lost")

    real = ingest.append_change_log
    with monkeypatch.context() as patch:
        if moment == "quarantine":
            patch.setattr(ingest, "append_change_log", lost)
        elif moment == "staged":
            patch.setattr(ingest, "append_change_log", lambda rows, path, n: (real(rows.where("key < 'k5'"), path, n), lost()))
        else:
            patch.setattr(BatchCommit, "_publish", lost)
        with pytest.raises(Exception, match="executor lost"):
            run(spark, source, log, checkpoint, **options)
        # readers see no part of a batch that is not published
        assert [r[1] for r in logged(spark, log)] == ["k"]
    # a query that has committed before never reads the log
    monkeypatch.setattr(ingest, "without_logged", lost)
    run(spark, source, log, checkpoint, **options)
    assert [r[1] for r in logged(spark, log)] == ["k"] + [f"k{i}" for i in range(10)]
    assert len(aside(spark, away)) == 2
    assert not list((log / "_batches").glob("*/batch-*")) and len(list((log / "_batches").glob("*/*.committed"))) == 1


def test_incomplete_documents_have_no_place_in_the_log(spark, tmp_path):
    for options in ({"on_invalid": "keep"}, {"on_invalid": "quarantine"}, {"quarantine": "x"}):
        with pytest.raises(ValueError):
            run(spark, tmp_path, tmp_path / "log", tmp_path / "cp", **options)


def test_repaired_events_are_delivered_again(spark, tmp_path):
    from tidemark.sinks.quarantine import read_quarantine, requeue

    source, log, away = tmp_path / "in", tmp_path / "log", tmp_path / "away"
    good = document("t", "a", 1)
    land(source, "1.json", good.replace("~id", "~di"))
    (source / "2.json").write_text('[{"content":' + good.replace('"a"', '"b"') + "}\n")
    options = {"on_invalid": "quarantine", "quarantine": str(away)}
    run(spark, source, log, tmp_path / "cp", **options)
    assert logged(spark, log) == []
    repaired = read_quarantine(spark, str(away)).withColumn(
        "value", F.when(F.col("eventKey").isNull(), F.concat("value", F.lit("]"))).otherwise(F.replace("value", F.lit("~di"), F.lit("~id")))
    )
    requeue(repaired, str(source))
    run(spark, source, log, tmp_path / "cp", **options)
    assert logged(spark, log) == [("t", k, 1, False, document("t", k, 1)) for k in "ab"]


def test_a_stop_finishes_the_batch_and_a_restart_repeats_nothing(spark, tmp_path, monkeypatch):
    from tidemark.streaming.control import BatchProgress, StopMarker, run_until_stopped

    source, log = tmp_path / "in", tmp_path / "log"
    for n in range(3):
        land(source, f"{n}.json", *[document("t", f"k{n}{i}", 1) for i in range(5)])
    stop = StopMarker(spark, f"file://{tmp_path}/stop")
    real, batches = ingest.append_change_log, []

    def slow(rows, path, partitions):
        batches.append(path)
        stop.request()  # as if from elsewhere, while the batch runs
        real(rows, path, partitions)

    progress = BatchProgress()
    spark.streams.addListener(progress)
    try:
        with monkeypatch.context() as patch:
            patch.setattr(ingest, "append_change_log", slow)
            events = landed_events(spark, str(source), 1)
            query = ingest.ingest_changes(events, str(log), str(tmp_path / "cp"), interval="0 seconds", stop=stop)
            assert run_until_stopped(query, stop, 0.2)
        assert not query.isActive and len(batches) == 1 and len(logged(spark, log)) == 5
        stop.clear()
        run(spark, source, log, tmp_path / "cp", stop=stop)
        assert len(logged(spark, log)) == 15
    finally:
        spark.streams.removeListener(progress)
    assert any(rows for batches in progress.batches.values() for _, rows, _ in batches)
