"""Snapshots: ``<root>/<yyyy-MM-dd-HH-mm-ss>/<table directory>/<file>``, JSON lines, gzip by suffix.

The table directory is the encoded table name, plain or as ``table=<name>``; both forms are read.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from tidemark.functions.metadata import METADATA_COLUMNS, require_complete, with_metadata
from tidemark.functions.naming import decode_table_name, encoded_table_of_path, file_name_of, in_table_folder
from tidemark.operators.table_set import TableSet
from tidemark.schema import POINTER_FILE
from tidemark.session import scratch_path, stage
from tidemark.sources import storage
from tidemark.sources.whole_files import copy_renamed


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """Directory name of the newest finished snapshot, from the pointer file."""
    path = f"{root.rstrip('/')}/{POINTER_FILE}"
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"no previous snapshot available: {path} does not exist")
    name = storage.first_line(spark, path).strip()
    if not name:
        raise ValueError(f"no previous snapshot available: {path} is empty")
    return name


def _path_column():
    return F.col("_metadata.file_path")


def _named(df: DataFrame, tables: TableSet | None) -> DataFrame:
    """Table names for ``folder``, of the given tables if any."""
    if tables is None:
        return df.withColumn("table", decode_table_name(F.col("folder")))
    return tables.keep_folders(df)


# Folders that unfinished Spark writes leave; no tables.
_UNFINISHED = ("_temporary", ".spark-staging", "_spark_metadata")


def _is_hidden(name: str) -> bool:
    return name.startswith(("_", "."))


class Snapshot:
    """One snapshot. Its files are listed once per kind of use, whatever number of frames are derived.

    Spark's readers pass over folders and files whose names start with ``_`` or ``.``, which table names may. Such
    tables are copied once to readable names, below ``work`` or a scratch folder of its own, and read from there.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, work: str | None = None):
        self.spark = spark
        self.name = name
        self.path = storage.qualified(spark, f"{root.rstrip('/')}/{name}")
        self._work = work

    @cached_property
    def _paths(self) -> list[str]:
        """The snapshot's folder and, if it has hidden tables, the folder of their readable copies."""
        tables = [
            (name, uri)
            for name, uri, is_folder, _ in storage.entries(self.spark, self.path)
            if is_folder and _is_hidden(name) and not name.startswith(_UNFINISHED)
        ]
        rows = []
        for folder, uri in tables:
            for file, path, is_folder, _ in storage.entries(self.spark, uri):
                # a file is named after its table; other hidden files are checksums and leftovers
                if not is_folder and (file.startswith(f"{folder}-") or not _is_hidden(file)) and not file.endswith(".crc"):
                    rows.append((folder, path, f"f{file}" if _is_hidden(file) else file))
        if not rows:
            return [self.path]
        work = self._work or scratch_path(self.spark, "hidden")
        goal = storage.qualified(self.spark, f"{work}/readable-{uuid.uuid4().hex}/{self.name}")
        listed = self.spark.createDataFrame(rows, "folder string, path string, file string")
        copy_renamed(listed, goal).count()
        return [self.path, goal]

    @cached_property
    def exists(self) -> bool:
        return storage.exists(self.spark, self.path)

    @cached_property
    def _text(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").text(self._paths)

    @cached_property
    def _listing(self) -> DataFrame:
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self._paths)

    def files(self, tables: TableSet | None = None) -> DataFrame:
        """``table, file, path, bytes`` of every file. A listing only: no file is opened."""
        if not self.exists:
            return self.spark.createDataFrame([], "table string, file string, path string, bytes long")
        files = self._listing.where(in_table_folder(_path_column(), self.name)).select(
            encoded_table_of_path(_path_column()).alias("folder"),
            file_name_of(_path_column()).alias("file"),
            _path_column().alias("path"),
            F.col("length").alias("bytes"),
        )
        return _named(files, tables).select("table", "file", "path", "bytes")

    def lines(self, tables: TableSet | None = None, position: bool = True) -> DataFrame:
        """Non-empty lines as ``table, file, value`` and, on demand, their position ``block, seq``.

        ``(file, block, seq)`` orders the lines of a table's files like the file name and line number do, and
        comes from the scan alone: no shuffle. ``seq`` says nothing across files. A missing snapshot reads as
        empty. A literal table set is applied to the file list, so other tables' files are not opened.
        """
        columns = ["table", "file", "value"] + (["block", "seq"] if position else [])
        if not self.exists:
            empty = self.spark.createDataFrame([], "table string, file string, value string, block long, seq long")
            return empty.select(columns)
        lines = self._text.where((F.col("value") != "") & in_table_folder(_path_column(), self.name)).select(
            encoded_table_of_path(_path_column()).alias("folder"),
            file_name_of(_path_column()).alias("file"),
            "value",
            F.col("_metadata.file_block_start").alias("block"),
        )
        lines = _named(lines, tables)
        if position:
            # after the filters: nothing can be pushed below a row id
            lines = lines.withColumn("seq", F.monotonically_increasing_id())
        return lines.select(columns)

    def documents(self, tables: TableSet | None = None, position: bool = True, strict: bool = True) -> DataFrame:
        """``table, key, file, value`` and position of every document."""
        return with_keys(self.lines(tables, position), strict)


def snapshot_files(
    spark: SparkSession, root: str, name: str, tables: TableSet | None = None, work: str | None = None
) -> DataFrame:
    return Snapshot(spark, root, name, work).files(tables)


def scan_snapshot_lines(
    spark: SparkSession, root: str, name: str, tables: TableSet | None = None, position: bool = True
) -> DataFrame:
    return Snapshot(spark, root, name).lines(tables, position)


def scan_snapshot_keys(
    spark: SparkSession,
    root: str,
    name: str,
    tables: TableSet | None = None,
    position: bool = True,
    strict: bool = True,
) -> DataFrame:
    return Snapshot(spark, root, name).documents(tables, position, strict)


def with_keys(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Add the document key. The table stays the directory's, whatever the document says.

    ``strict`` fails on a line that lacks any of the five attributes, otherwise only the key is required.
    """
    parsed = require_complete(
        with_metadata(lines.withColumnRenamed("table", "_directory")), attributes=METADATA_COLUMNS if strict else ["key"]
    )
    return parsed.select(F.col("_directory").alias("table"), "key", *[c for c in lines.columns if c != "table"])


# A row per split, with overhead; up to so many of them the shifts are broadcast.
_BROADCAST_SPLITS = 200_000


def number_lines(lines: DataFrame) -> DataFrame:
    """Replace ``block, seq`` by the 1-based line number within the file, blank lines not counted.

    ``seq`` runs on within a split, so a line's number is its distance from the split's first plus the lines of the
    file's earlier splits. Both are found at once by a pass over the position columns; the text itself is numbered where
    it is read. Only with very many splits are lines shuffled, by split.
    """
    split = ["table", "file", "block"]
    counts = stage(lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_lines"), F.min("seq").alias("_first")), "splits")
    earlier = Window.partitionBy("table", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    if counts.count() <= _BROADCAST_SPLITS:
        shifts = F.broadcast(shifts)
    numbered = lines.join(shifts, split, "left").withColumn("_at", F.col("seq") - F.col("_first"))
    # the files are read twice; should Spark have cut them differently the second time, fail rather than misnumber
    line = F.when((F.col("_at") >= 0) & (F.col("_at") < F.col("_lines")), (F.col("_before") + F.col("_at") + 1).cast("int")).otherwise(
        F.raise_error(F.lit("file splits changed while lines were numbered; run again"))
    )
    return numbered.withColumn("line", line).drop("block", "seq", "_lines", "_first", "_before", "_at")
