"""Spreading whole files, which nothing can split, evenly over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Lists of files that running totals are made of; their sums are broadcast, one row each.
_LISTS = 1024


def balanced_tasks(files: DataFrame, tasks: int, count: int, total: int) -> DataFrame:
    """Add ``task``, from 0, to a listing with ``path`` and ``bytes``; there are ``count`` files of together ``total`` bytes.

    A file weighs its bytes and those of an average file, so that neither bytes nor numbers pile up. The running total of the
    weights is cut into equal shares: no task gets more than twice the mean bytes plus one file, nor more than twice the mean number of
    files plus one. Running totals are made within lists by hash of the path and joined by the sums of the lists before. A null size
    weighs as an empty file.
    """
    mean = max(1, -(-total // max(count, 1)))
    weight = F.coalesce(F.col("bytes"), F.lit(0)) + F.lit(mean).cast("bigint")
    # the larger whole share: the last task's number stays below the number of tasks
    share = max(1, -(-(total + mean * count) // max(tasks, 1)))
    listed = files.withColumns({"_list": F.pmod(F.xxhash64("path"), F.lit(_LISTS)), "_weight": weight})
    sums = listed.groupBy("_list").agg(F.sum("_weight").alias("_sum"))
    lists_before = Window.orderBy("_list").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_list", F.coalesce(F.sum("_sum").over(lists_before), F.lit(0)).alias("_start"))
    files_before = Window.partitionBy("_list").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_start") + F.coalesce(F.sum("_weight").over(files_before), F.lit(0))
    placed = listed.join(F.broadcast(sums), "_list").withColumn("task", F.call_function("div", start, F.lit(share).cast("bigint")).cast("int"))
    return placed.select(*files.columns, "task")
