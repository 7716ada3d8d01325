"""The compaction job end to end, on files."""

from datetime import datetime
from pathlib import Path

import pytest
from support import change, document, point_at, read_back, write_file, write_log

from tidemark.plans.generate import generate_snapshot
from tidemark.sources.snapshot import latest_snapshot

PRIOR = "2018-01-07-00-00-00"
NEXT = "2018-01-09-00-00-00"


def live_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "`table` string")


@pytest.fixture
def world(spark, tmp_path):
    root = tmp_path / "root"
    for t in range(3):
        table = f"test:table:0{t}"
        for f in range(4):
            docs = [document(table, f"doc{4 * f + i}", text=f"old{t}") for i in range(4)]
            write_file(root, PRIOR, table, f"test~table~0{t}-000{f}.json", docs, trailing_newline=f == 0)
    # a repeated document, within a file and across files; the first file's first copy stays
    write_file(root, PRIOR, "test:table:01", "test~table~01-0004.json.gz",
               [document("test:table:01", "twice", text="first"), "", document("test:table:01", "twice", text="second"),
                document("test:table:01", "doc0", text="later file")])
    # carried forward although deleted; belongs to its directory although it says otherwise
    write_file(root, PRIOR, "test:table:01", "test~table~01-0005.json",
               [document("elsewhere", "gone", deleted=True), document("elsewhere", "stray")])
    # an unmodified table keeps its repeats
    write_file(root, PRIOR, "test:table:02", "test~table~02-0004.json.gz", [document("test:table:02", "doc0", text="again")])
    point_at(root, PRIOR)
    rows = [
        change("test:table:01", "doc1", 0, "20180107", "older version still wins"),
        change("test:table:01", "doc2", 9, "20180108", "v9"),
        change("test:table:01", "doc2", 10, "20180107", "v10"),
        change("test:table:01", "doc3", 4, "20180107", "v4"),
        change("test:table:01", "doc3", 5, "20180108", deleted=True),
        change("test:table:01", "fresh", 1, "20180108", "inserted"),
        change("test:table:01", "late", 1, "20180109", "on the excluded day"),
        change("test:table:01", "early", 1, "20180106", "before the window"),
        change("test:table:03", "only", 1, "20180107", "new table"),
        change("test:table:00", "doc0", 2, "20180107", "of a dropped table"),
        change("test:table:09", "doc0", 2, "20180107", "of an unknown table"),
    ]
    log = tmp_path / "log"
    write_log(spark, rows, log)
    # an append that ran twice
    write_log(spark, [change("test:table:01", "fresh", 1, "20180108", "inserted")], log)
    return root, log


LIVE = ["test:table:01", "test:table:02", "test:table:03", "test:table:04"]


def expected():
    t1, t2 = "test:table:01", "test:table:02"
    kept = [document(t1, f"doc{i}", text="old1") for i in range(16) if i not in (1, 2, 3)]
    return {
        t1: sorted(kept + [
            document(t1, "doc1", 0, "older version still wins"),
            document(t1, "doc2", 10, "v10"),
            document(t1, "fresh", 1, "inserted"),
            document(t1, "twice", text="first"),
            document("elsewhere", "gone", deleted=True),
            document("elsewhere", "stray"),
        ]),
        t2: sorted([document(t2, f"doc{i}", text="old2") for i in range(16)] + [document(t2, "doc0", text="again")]),
        "test:table:03": [document("test:table:03", "only", 1, "new table")],
    }


@pytest.mark.parametrize("limit", [1 << 20, 4096])
@pytest.mark.parametrize("regroup", [True, False])
def test_next_snapshot(spark, world, limit, regroup):
    root, log = world
    report = generate_snapshot(
        spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 9),
        filter_bytes=limit, regroup=regroup,
    )
    assert report.regrouped == regroup
    assert report.days == ["20180107", "20180108"]
    assert (report.updated, report.deleted, report.copied_files) == (4, 1, 5)
    assert [r[0] for r in report.dropped.collect()] == ["test:table:00", "test:table:09"]
    assert latest_snapshot(spark, str(root)) == NEXT
    assert read_back(root, NEXT) == expected()
    # the untouched table's files are the same bytes
    for old in (root / PRIOR / "test~table~02").iterdir():
        assert (root / NEXT / "table=test~table~02" / old.name).read_bytes() == old.read_bytes()


def test_all_tables_through_the_merge(spark, world):
    root, log = world
    report = generate_snapshot(spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 9), copy_unmodified=False)
    want = expected()
    want["test:table:02"] = sorted(document("test:table:02", f"doc{i}", text="old2") for i in range(16))
    assert read_back(root, NEXT) == want
    assert report.copied_files == 0


def test_second_snapshot_builds_on_the_first(spark, world):
    root, log = world
    live = live_frame(spark, LIVE)
    generate_snapshot(spark, str(root), str(log), live, datetime(2018, 1, 9))
    generate_snapshot(spark, str(root), str(log), live, datetime(2018, 1, 9, 12))
    want = expected()
    want["test:table:01"] = sorted(want["test:table:01"] + [document("test:table:01", "late", 1, "on the excluded day")])
    assert read_back(root, "2018-01-09-12-00-00") == want


def test_older_time_is_refused_before_anything_is_written(spark, world):
    root, log = world
    with pytest.raises(ValueError):
        generate_snapshot(spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 7))
    assert sorted(p.name for p in Path(root).iterdir() if not p.name.startswith(".")) == [PRIOR, "_LATEST"]


def test_failure_leaves_the_pointer_alone(spark, world):
    root, log = world
    write_file(root, PRIOR, "test:table:01", "test~table~01-0009.json", ['{"~id":"broken"}'])
    with pytest.raises(Exception, match="lacks a required attribute"):
        generate_snapshot(spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 9))
    assert latest_snapshot(spark, str(root)) == PRIOR
    (root / PRIOR / "test~table~01" / "test~table~01-0009.json").unlink()
    generate_snapshot(spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 9))
    assert read_back(root, NEXT) == expected()


def test_other_output_root(spark, world, tmp_path):
    root, log = world
    out = tmp_path / "out"
    generate_snapshot(spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 9), output_root=str(out))
    assert latest_snapshot(spark, str(root)) == PRIOR
    assert latest_snapshot(spark, str(out)) == NEXT
    assert read_back(out, NEXT) == expected()


def test_missing_pointer(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no previous snapshot"):
        latest_snapshot(spark, str(tmp_path))


def test_lookback_reads_a_late_batch(spark, world):
    root, log = world
    write_log(spark, [change("test:table:03", "lagging", 1, "20180106", "late")], log)
    generate_snapshot(spark, str(root), str(log), live_frame(spark, LIVE), datetime(2018, 1, 9), lookback_days=1)
    assert document("test:table:03", "lagging", 1, "late") in read_back(root, NEXT)["test:table:03"]


def test_vouched_unique_prior_and_scratch_is_cleared(spark, tmp_path):
    root, log = tmp_path / "root", tmp_path / "log"
    write_file(root, PRIOR, "t", "a.json", [document("t", f"k{i}") for i in range(10)])
    point_at(root, PRIOR)
    write_log(spark, [change("t", "k3", 2, "20180107", "new"), change("t", "k4", 2, "20180107", deleted=True)], log)
    scratch = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    for step, limit in enumerate((1 << 20, 4096)):
        out = tmp_path / f"out{step}"
        generate_snapshot(
            spark, str(root), str(log), live_frame(spark, ["t"]), datetime(2018, 1, 9), output_root=str(out),
            prior_unique=True, filter_bytes=limit, documents_per_file=4,
        )
        kept = [document("t", f"k{i}") for i in range(10) if i not in (3, 4)]
        assert read_back(out, NEXT) == {"t": sorted(kept + [document("t", "k3", 2, "new")])}
    assert not [p for kind in ("compaction", "status", "plan", "hidden") for p in scratch.glob(f"{kind}-*")]


def test_changes_in_another_encoding_fail(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.sinks.change_log import append_change_log
    from support import change_frame

    root, log = tmp_path / "root", tmp_path / "log"
    write_file(root, PRIOR, "t", "a.json", [document("t", "a")])
    point_at(root, PRIOR)
    rows = change_frame(spark, [change("t", "a", 2, "20180107")]).withColumn("encoding", F.lit(1))
    append_change_log(rows, str(log))
    with pytest.raises(Exception, match="unsupported encoding code 1"):
        generate_snapshot(spark, str(root), str(log), live_frame(spark, ["t"]), datetime(2018, 1, 9))
    assert latest_snapshot(spark, str(root)) == PRIOR


@pytest.mark.parametrize("folder", ["missing", "empty", "other tables"])
def test_new_tables_without_prior_files(spark, tmp_path, folder):
    root, log = tmp_path / "root", tmp_path / "log"
    point_at(root, PRIOR)
    if folder != "missing":
        (root / PRIOR).mkdir(parents=True)
    if folder == "other tables":
        write_file(root, PRIOR, "old", "a.json", [document("old", "a")])
    write_log(spark, [change("new", "k", 1, "20180107", "first")], log)
    generate_snapshot(spark, str(root), str(log), live_frame(spark, ["new", "old"]), datetime(2018, 1, 9))
    want = {"new": [document("new", "k", 1, "first")]} | ({"old": [document("old", "a")]} if folder == "other tables" else {})
    assert read_back(root, NEXT) == want


@pytest.mark.parametrize("plain", [False, True])
def test_tables_with_hidden_names_survive(spark, tmp_path, plain):
    from tidemark.sources.snapshot import scan_snapshot_keys

    root, log = tmp_path / "root", tmp_path / "log"
    names = ["__system:x", ".dot", "plain"]
    for name in names:
        write_file(root, PRIOR, name, f"{name.replace(':', '~')}-0000.gz", [document(name, "a"), document(name, "b")])
    (root / PRIOR / "_temporary" / "0").mkdir(parents=True)
    point_at(root, PRIOR)
    write_log(spark, [change("__system:x", "a", 2, "20180107", "new")], log)
    live = live_frame(spark, names)
    for day in (9, 10):
        generate_snapshot(spark, str(root), str(log), live, datetime(2018, 1, day), plain_names=plain)
        found = scan_snapshot_keys(spark, str(root), latest_snapshot(spark, str(root)), position=False)
        want = {(n, k): document(n, k, 2, "new") if (n, k) == ("__system:x", "a") else document(n, k) for n in names for k in "ab"}
        assert {(r["table"], r["key"]): r["value"] for r in found.collect()} == want


def test_two_tables_in_one_plain_folder_are_refused(spark, tmp_path):
    root, log = tmp_path / "root", tmp_path / "log"
    write_file(root, PRIOR, "other", "a.json", [document("other", "a")])
    point_at(root, PRIOR)
    write_log(spark, [change("a:b", "k", 1, "20180107"), change("a~b", "k", 1, "20180107")], log)
    with pytest.raises(Exception, match="two files of the snapshot would be named"):
        generate_snapshot(spark, str(root), str(log), live_frame(spark, ["a:b", "a~b"]), datetime(2018, 1, 9), plain_names=True, documents_per_file=1)
    assert latest_snapshot(spark, str(root)) == PRIOR


def test_plain_names(spark, world):
    import gzip
    import hashlib
    import json

    root, log = world
    live = live_frame(spark, LIVE)
    generate_snapshot(spark, str(root), str(log), live, datetime(2018, 1, 9), plain_names=True)
    assert read_back(root, NEXT) == expected()
    folders = sorted(p.name for p in (root / NEXT).iterdir() if p.is_dir())
    assert folders == ["test~table~01", "test~table~02", "test~table~03"]
    for file in (root / NEXT / "test~table~01").glob("*.gz"):
        first = json.loads(gzip.decompress(file.read_bytes()).split(b"\n")[0])["~id"]
        assert file.name == f"test~table~01-{hashlib.md5(first.encode()).hexdigest()}.gz"
    # the next run reads this layout as well
    generate_snapshot(spark, str(root), str(log), live, datetime(2018, 1, 9, 0, 0, 1), plain_names=True)
    want = expected()
    want["test:table:01"] = sorted(want["test:table:01"] + [document("test:table:01", "late", 1, "on the excluded day")])
    assert read_back(root, "2018-01-09-00-00-01") == want


def test_only_the_window_is_listed(spark, tmp_path):
    from tidemark.sources.change_log import read_change_log

    write_log(spark, [change("t", "a", 1, "20180107"), change("t", "b", 1, "20180108")], tmp_path / "log")
    window = read_change_log(spark, str(tmp_path / "log"), ["20180108", "20180109"])
    assert [(r["key"], r["pollDate"], r["table"]) for r in window.collect()] == [("b", "20180108", "t")]
    assert all("pollDate=20180108" in f for f in window.inputFiles())
    assert read_change_log(spark, str(tmp_path / "log"), ["20190101"]).count() == 0
    assert read_change_log(spark, str(tmp_path / "none"), ["20190101"]).count() == 0


def test_no_changes_at_all(spark, tmp_path):
    root = tmp_path / "root"
    write_file(root, PRIOR, "t", "a.json", [document("t", "a")])
    point_at(root, PRIOR)
    report = generate_snapshot(spark, str(root), str(tmp_path / "none"), live_frame(spark, ["t"]), datetime(2018, 1, 9))
    assert (report.updated, report.copied_files) == (0, 1)
    assert read_back(root, NEXT) == {"t": [document("t", "a")]}
    generate_snapshot(spark, str(root), str(tmp_path / "none"), live_frame(spark, ["t"]), datetime(2018, 1, 10), copy_unmodified=False)
    assert read_back(root, "2018-01-10-00-00-00") == {"t": [document("t", "a")]}


@pytest.mark.parametrize("prior_unique", [False, True])
def test_a_crowded_key_filter_changes_nothing(spark, tmp_path, prior_unique):
    root, log = tmp_path / "root", tmp_path / "log"
    tables = {"few": 1, "some": 3, "many": 40}
    for table in tables:
        write_file(root, PRIOR, table, "a.json", [document(table, f"k{i:02}") for i in range(50)])
        if not prior_unique:
            write_file(root, PRIOR, table, "b.json", [document(table, f"k{i:02}", text="again") for i in range(45, 50)])
    point_at(root, PRIOR)
    rows = [change(t, f"k{i:02}", 2, "20180107", "new") for t, n in tables.items() for i in range(n)]
    write_log(spark, rows, log)
    report = generate_snapshot(
        spark, str(root), str(log), live_frame(spark, list(tables)), datetime(2018, 1, 9),
        filter_bytes=4096, prior_unique=prior_unique,
    )
    assert report.updated == 44
    want = {
        t: sorted([document(t, f"k{i:02}", 2, "new") for i in range(n)] + [document(t, f"k{i:02}") for i in range(n, 50)])
        for t, n in tables.items()
    }
    assert read_back(root, NEXT) == want


@pytest.mark.parametrize("literal_names", [1000, 1])
def test_a_tilde_in_a_table_name(spark, tmp_path, monkeypatch, literal_names):
    """Directories are found from names, so such a table is not taken for the one with a colon."""
    from tidemark.operators.table_set import TableSet

    real = TableSet.by_action
    monkeypatch.setattr(TableSet, "by_action", staticmethod(lambda status: real(status, literal_names)))
    root, log = tmp_path / "root", tmp_path / "log"
    write_file(root, PRIOR, "a~b", "a.json", [document("a~b", "k1"), document("a~b", "k2")])
    write_file(root, PRIOR, "c~d", "c.json", [document("c~d", "k1")])
    write_file(root, PRIOR, "e:f", "e.json", [document("e:f", "k1")])
    point_at(root, PRIOR)
    write_log(spark, [change("a~b", "k1", 2, "20180107", "new"), change("e:f", "k2", 2, "20180107", "new")], log)
    live = live_frame(spark, ["a~b", "c~d", "e:f"])
    report = generate_snapshot(spark, str(root), str(log), live, datetime(2018, 1, 9))
    assert report.copied_files == 1
    assert read_back(root, NEXT) == {
        "a:b": sorted([document("a~b", "k1", 2, "new"), document("a~b", "k2")]),
        "c:d": [document("c~d", "k1")],
        "e:f": sorted([document("e:f", "k1"), document("e:f", "k2", 2, "new")]),
    }


def test_the_manifest_saves_the_search_for_repeated_keys(spark, tmp_path, monkeypatch):
    """First run: every merged table is searched. Next run: only one that was never merged is, and all texts are read once."""
    from tidemark.sinks.manifest import read_manifest
    from tidemark.sources.snapshot import Snapshot

    root, log = tmp_path / "root", tmp_path / "log"
    repeated = [document("u", f"k{i % 6}", text=str(i)) for i in range(10)]
    write_file(root, PRIOR, "t", "a.json", [document("t", f"k{i}") for i in range(10)] + [document("t", "k0", text="again")])
    write_file(root, PRIOR, "u", "a.json", repeated)
    point_at(root, PRIOR)
    write_log(spark, [
        change("t", "k3", 2, "20180107", "new"), change("t", "k4", 2, "20180107", deleted=True),
        change("t", "k5", 2, "20180109", "newer"), change("u", "k0", 2, "20180109", "new"),
    ], log)
    read = []
    real = Snapshot.documents

    def counted(self, tables=None, position=True, strict=True):
        read.append(sorted(tables.names))
        return real(self, tables, position, strict)

    monkeypatch.setattr(Snapshot, "documents", counted)
    report = generate_snapshot(spark, str(root), str(log), live_frame(spark, ["t", "u"]), datetime(2018, 1, 9))
    assert read == [["t"], ["t"]]
    assert (report.updated, report.deleted, report.carried, report.copied_files) == (1, 1, 8, 1)
    assert {tuple(r) for r in read_manifest(spark, str(root), NEXT).collect()} == {("t", True), ("u", False)}

    read.clear()
    report = generate_snapshot(spark, str(root), str(log), live_frame(spark, ["t", "u"]), datetime(2018, 1, 10))
    assert sorted(read) == [["t", "u"], ["u"]]
    assert (report.updated, report.deleted, report.carried, report.copied_files) == (2, 0, 8 + 5, 0)
    kept = [document("t", f"k{i}") for i in range(10) if i not in (3, 4, 5)]
    assert read_back(root, report.name) == {
        "t": sorted(kept + [document("t", "k3", 2, "new"), document("t", "k5", 2, "newer")]),
        "u": sorted([document("u", f"k{i}", text=str(i)) for i in range(1, 6)] + [document("u", "k0", 2, "new")]),
    }

    read.clear()
    report = generate_snapshot(spark, str(root), str(log), live_frame(spark, ["t", "u"]), datetime(2018, 1, 11), lookback_days=1)
    assert read == [["t", "u"]]


def test_without_the_prior_manifest_all_tables_are_searched(spark, tmp_path):
    import shutil

    root, log = tmp_path / "root", tmp_path / "log"
    write_file(root, PRIOR, "t", "a.json", [document("t", f"k{i % 3}") for i in range(6)])
    point_at(root, PRIOR)
    write_log(spark, [change("t", "k0", 2, "20180107", "new"), change("t", "k1", 2, "20180109", "new")], log)
    generate_snapshot(spark, str(root), str(log), live_frame(spark, ["t"]), datetime(2018, 1, 9))
    shutil.rmtree(root / "_manifests")
    report = generate_snapshot(spark, str(root), str(log), live_frame(spark, ["t"]), datetime(2018, 1, 10))
    assert read_back(root, report.name) == {"t": sorted([document("t", "k0", 2, "new"), document("t", "k1", 2, "new"), document("t", "k2")])}
