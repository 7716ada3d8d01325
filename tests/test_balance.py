"""Whole files spread evenly over tasks."""

import random

import pytest

from tidemark.operators.balance import balanced_tasks


def held(spark, sizes, tasks):
    files = spark.createDataFrame([(f"f{i}", n, "x") for i, n in enumerate(sizes)], "path string, bytes long, task_name string")
    known = [n or 0 for n in sizes]
    rows = balanced_tasks(files, tasks, len(sizes), sum(known)).collect()
    assert sorted(r["path"] for r in rows) == sorted(f"f{i}" for i in range(len(sizes)))
    assert all(0 <= r["task"] < tasks for r in rows)
    found = {}
    for r in rows:
        found.setdefault(r["task"], []).append(r["bytes"] or 0)
    return found


@pytest.mark.parametrize("sizes", [
    [100] * 99 + [10_000],
    [1] * 500 + [0] * 500,
    [random.Random(3).randrange(1, 5000) for _ in range(400)],
])
def test_no_task_holds_more_than_twice_the_mean_and_a_file(spark, sizes):
    tasks = 10
    found = held(spark, sizes, tasks)
    largest = max(sizes)
    for mine in found.values():
        assert sum(mine) <= 2 * (sum(sizes) / tasks + 1) + largest
        assert len(mine) <= 2 * len(sizes) / tasks + 2


def test_few_empty_or_unknown_files(spark):
    assert len(held(spark, [5], 3)) == 1
    assert sum(len(x) for x in held(spark, [0, 0, None], 2).values()) == 3
    empty = spark.createDataFrame([], "path string, bytes long")
    assert balanced_tasks(empty, 1, 0, 0).collect() == []
