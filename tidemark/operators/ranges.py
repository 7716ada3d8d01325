"""Cutting each table into contiguous ranges of keys of equal size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.combine import files_for
from tidemark.schema import DOCUMENT_KEY, DOCUMENTS_PER_FILE
from tidemark.session import stage

# Rows of counts, one for each task of the sort and table in it, that are broadcast.
_BROADCAST_COUNTS = 200_000


def number_by_range(rows: DataFrame, documents_per_file: int = DOCUMENTS_PER_FILE, work: str | None = None) -> DataFrame:
    """Add ``file_number`` within the table and ``ordinal`` over all tables: the file whose range of keys a row falls into; and ``task``.

    A table gets as many ranges as hold ``documents_per_file`` rows each; their sizes differ by at most one row. These are exact
    quantiles: the rows are sorted in ranges that Spark chooses, and these get their offsets from counts, so a table that holds
    most rows costs no task more than others. ``task`` numbers, from 0, tasks that hold one range each, or several small tables of
    together less than twice ``documents_per_file`` rows. Meant for narrow rows; what is wide joins the numbers afterwards. Rows with the same
    key may fall into neighbouring ranges.
    """
    ranges = rows.repartitionByRange(*DOCUMENT_KEY).sortWithinPartitions(*DOCUMENT_KEY)
    ranges = stage(ranges.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_seq")), "ranges", work)
    counts = stage(ranges.groupBy("_range", "table").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first")), "range-counts", work)
    earlier = Window.partitionBy("table").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per table
    tables = counts.groupBy("table").agg(F.sum("_rows").alias("_total"))
    tables = tables.withColumn("_files", files_for(F.col("_total"), documents_per_file))
    of_earlier_tables = Window.orderBy("table").rowsBetween(Window.unboundedPreceding, -1)
    small = F.col("_files") == 1
    tables = tables.withColumns(
        {
            "_offset": F.coalesce(F.sum("_files").over(of_earlier_tables), F.lit(0)),
            "_large": F.coalesce(F.sum(F.when(~small, F.col("_files"))).over(of_earlier_tables), F.lit(0)),
            "_shared": F.call_function(
                "div", F.coalesce(F.sum(F.when(small, F.col("_total"))).over(of_earlier_tables), F.lit(0)), F.lit(documents_per_file).cast("bigint")
            ),
        }
    )
    # tasks of small tables first: their numbers leave no gap, as none of these tables is larger than a file
    shared = F.coalesce(F.max(F.when(small, F.col("_shared") + 1)).over(Window.partitionBy(F.lit(0))), F.lit(0))
    tables = tables.withColumn("_task", F.when(small, F.col("_shared")).otherwise(shared + F.col("_large"))).drop("_large", "_shared")
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows").join(tables, "table")
    if counts.count() <= _BROADCAST_COUNTS:
        counts = F.broadcast(counts)
    rank = F.col("_before") + F.col("_seq") - F.col("_first")
    number = F.call_function("div", rank * F.col("_files"), F.col("_total"))
    numbered = ranges.join(counts, ["_range", "table"]).withColumn("file_number", number)
    return numbered.select(
        *rows.columns, "file_number", (F.col("_offset") + F.col("file_number")).alias("ordinal"), (F.col("_task") + F.col("file_number")).cast("int").alias("task")
    )


def key_ranges(keys: DataFrame, documents_per_file: int = DOCUMENTS_PER_FILE, work: str | None = None) -> DataFrame:
    """``table, file_number, first_key, last_key, documents, ordinal``: the range of each file, see :func:`number_by_range`."""
    numbered = number_by_range(keys.select(*DOCUMENT_KEY), documents_per_file, work)
    return numbered.groupBy("table", "file_number").agg(
        F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count(F.lit(1)).alias("documents"), F.first("ordinal").alias("ordinal")
    )
