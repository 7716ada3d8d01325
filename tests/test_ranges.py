"""Contiguous ranges of keys."""

import gzip
import json
import random

from tidemark.operators.ranges import key_ranges, number_by_range
from tidemark.sinks.snapshot import write_snapshot


def keys_frame(spark, sizes, seed=1):
    rows = [(t, f"k{i:05}é" if i % 7 else f"K{i}") for t, n in sizes.items() for i in range(n)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "`table` string, key string").repartition(5), rows


def test_ranges_are_equal_and_do_not_overlap(spark):
    frame, rows = keys_frame(spark, {"hot": 2000, "b": 101, "c": 100, "d": 1})
    found = key_ranges(frame, 100).orderBy("table", "file_number").collect()
    assert [r["ordinal"] for r in found] == list(range(len(found)))
    for table, files in {"hot": 20, "b": 2, "c": 1, "d": 1}.items():
        mine = [r for r in found if r["table"] == table]
        keys = sorted((k for t, k in rows if t == table), key=str.encode)
        assert len(mine) == files and sum(r["documents"] for r in mine) == len(keys)
        assert max(r["documents"] for r in mine) <= 100 and max(r["documents"] for r in mine) <= 2 * min(r["documents"] for r in mine)
        at = 0
        for r in mine:
            assert (r["first_key"], r["last_key"]) == (keys[at], keys[at + r["documents"] - 1])
            at += r["documents"]
    assert key_ranges(frame.where("false"), 100).collect() == []


def test_every_row_is_numbered_once_with_its_columns(spark):
    frame, rows = keys_frame(spark, {"a": 777, "b": 3})
    frame = frame.unionByName(frame.where("key = 'K0'")).selectExpr("*", "length(key) AS size")
    found = number_by_range(frame, 10).collect()
    assert sorted((r["table"], r["key"]) for r in found) == sorted(rows + [("a", "K0"), ("b", "K0")])
    assert all(r["size"] == len(r["key"]) for r in found)
    for table, offset, files in (("a", 0, 78), ("b", 78, 1)):
        mine = sorted((r for r in found if r["table"] == table), key=lambda r: r["key"].encode())
        assert [r["ordinal"] - offset for r in mine] == [r["file_number"] for r in mine] == sorted(r["file_number"] for r in mine)
        assert {r["file_number"] for r in mine} == set(range(files))


def test_small_tables_share_tasks_and_ranges_of_one_table_do_not(spark):
    sizes = {"a": 35, **{f"s{i}": 3 for i in range(20)}, "t": 21, "z": 10}
    frame, _ = keys_frame(spark, sizes)
    found = number_by_range(frame, 10).groupBy("task", "table", "file_number").count().collect()
    tasks = {}
    for r in found:
        tasks.setdefault(r["task"], []).append(r)
    assert sorted(tasks) == list(range(len(tasks)))
    for rows in tasks.values():
        assert len({r["table"] for r in rows}) == len(rows) and sum(r["count"] for r in rows) < 20
        assert len(rows) == 1 or all(sizes[r["table"]] <= 10 for r in rows)
    # sixty rows of small tables and ten of another, and four and three ranges
    assert len(tasks) == 7 + 7


def test_files_of_a_table_are_ranges_of_keys(spark, tmp_path):
    sizes = {"hot:t": 1500, "b": 101, "c": 100, "d": 1}
    frame, rows = keys_frame(spark, sizes)
    documents = frame.selectExpr("*", "to_json(struct(key AS `~id`)) AS value")
    write_snapshot(documents.unionByName(documents.where("key = 'K0'")), str(tmp_path / "s"), documents_per_file=100)
    for table, size in sizes.items():
        size += 1  # the repeated one
        files = [[json.loads(line)["~id"].encode() for line in gzip.decompress(f.read_bytes()).splitlines()]
                 for f in (tmp_path / "s" / ("table=" + table.replace(":", "~"))).glob("*.gz")]
        assert all(keys == sorted(keys) for keys in files)
        files.sort()
        assert sum(len(keys) for keys in files) == size and len(files) == -(-size // 100)
        assert all(a[-1] < b[0] for a, b in zip(files, files[1:]))
        assert max(len(keys) for keys in files) <= 2 * min(len(keys) for keys in files)
