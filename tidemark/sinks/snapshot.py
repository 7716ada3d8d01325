"""Writing snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.naming import encode_table_name, folder_name_of
from tidemark.operators.balance import balanced_tasks
from tidemark.operators.ranges import number_by_range
from tidemark.schema import DOCUMENT_KEY, DOCUMENTS_PER_FILE, FILES_PER_COPY_TASK, POINTER_FILE
from tidemark.session import scratch_path, stage
from tidemark.sources import storage
from tidemark.sources.whole_files import file_tools


# Large files are spread over more tasks than their number asks for.
BYTES_PER_COPY_TASK = 512 * 1024 * 1024


def group_into_files(documents: DataFrame, tasks: int) -> DataFrame:
    """Bring the documents of each output file together: one shuffle, to the task whose number ``task`` gives.

    A task holds one range of keys of one table, or several small tables (:func:`tidemark.operators.ranges.number_by_range`), in
    order, and so do the files it writes.
    """
    return documents.repartitionById(tasks, F.col("task")).sortWithinPartitions("table", "key")


def _with_tasks(documents: DataFrame, documents_per_file: int, work: str) -> tuple[DataFrame, int]:
    """``documents`` and the task each belongs to, copies of a document to one; and the number of tasks."""
    numbered = number_by_range(documents.select(*DOCUMENT_KEY), documents_per_file, work)
    places = stage(numbered.groupBy(*DOCUMENT_KEY).agg(F.min("task").alias("task")), "places", work)
    tasks = (places.agg(F.max("task")).first()[0] or 0) + 1
    return documents.join(places, DOCUMENT_KEY, "left").withColumn("task", F.coalesce("task", F.lit(0))), tasks


def write_snapshot(
    documents: DataFrame,
    path: str,
    documents_per_file: int = DOCUMENTS_PER_FILE,
    tasks: int | None = None,
    grouped: bool = True,
    mode: str = "overwrite",
    work: str | None = None,
) -> None:
    """``table, key, value`` rows to gzipped JSON lines, one directory per table.

    Grouped, each table gets ``rows / documents_per_file`` files, rounded up, of equally many documents; each holds a contiguous range of
    keys, sorted, and no two files of a table overlap. Rows that come with a ``task`` below ``tasks``, as
    :func:`tidemark.operators.ranges.number_by_range` gives it, are shuffled once; else the keys are numbered first and joined.
    Ungrouped rows are written by the tasks that hold them, without a shuffle. Either way no file exceeds ``documents_per_file``.
    """
    spark, own = documents.sparkSession, None
    try:
        if grouped and tasks is None:
            own = None if work else scratch_path(spark, "plan")
            documents, tasks = _with_tasks(documents.select(*DOCUMENT_KEY, "value"), documents_per_file, work or own)
        # encoded before the sort: the writer then finds its partition column in order and does not sort again
        documents = documents.withColumn("table", encode_table_name(F.col("table")))
        if grouped:
            documents = group_into_files(documents, tasks)
        (
            documents.select("table", "value")
            .write.mode(mode)
            .partitionBy("table")
            .option("compression", "gzip")
            .option("maxRecordsPerFile", documents_per_file)
            .text(path)
        )
    finally:
        if own:
            storage.delete(spark, own)


def _spread(files: DataFrame) -> DataFrame:
    """A file listing at about twenty files or :data:`BYTES_PER_COPY_TASK` per task, balanced by bytes; only names are shuffled."""
    count, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, -(-count // FILES_PER_COPY_TASK), -(-total // BYTES_PER_COPY_TASK))
    named = files.select("table", "file", "path", "bytes", folder_name_of(F.col("path")).alias("folder"))
    return balanced_tasks(named, tasks, count, total).repartitionById(tasks, F.col("task")).drop("task", "bytes")


def copy_files(files: DataFrame, target: str, plain: bool = False) -> DataFrame:
    """Copy snapshot files byte for byte, about twenty per task and evenly by bytes; returns ``table, file, bytes`` as copied.

    ``files`` is a listing as :func:`tidemark.sources.snapshot.snapshot_files` gives it. File names stay; the table
    directory becomes ``table=<name>`` like the ones the writer makes, or ``<name>`` if ``plain``. Each task streams
    its files, and a repeated attempt replaces the file, so task retries are harmless. The result is lazy: the copy
    happens when it is counted or written.
    """
    goal = storage.qualified(files.sparkSession, target)
    opened, partition_folder, plain_folder = file_tools()
    folder_for = plain_folder if plain else partition_folder

    def copy(batches):
        import uuid

        from pyarrow import fs

        for batch in batches:
            sizes = []
            for path, folder, file in zip(batch["path"], batch["folder"], batch["file"]):
                source, source_path = opened(path)
                sink, base = opened(goal)
                folder_path = f"{base}/{folder_for(folder)}"
                sink.create_dir(folder_path, recursive=True)
                beside = f"{folder_path}/.{file}.{uuid.uuid4().hex}"
                fs.copy_files(source_path, beside, source_filesystem=source, destination_filesystem=sink)
                sink.move(beside, f"{folder_path}/{file}")
                sizes.append(sink.get_file_info(f"{folder_path}/{file}").size)
            yield batch[["table", "file"]].assign(bytes=sizes)

    return _spread(files).mapInPandas(copy, "table string, file string, bytes long")


def name_files(files: DataFrame, target: str, work: str | None = None) -> int:
    """Turn a written snapshot's layout into ``<table>/<table>-<md5 of the first key>.gz``; returns the number of files.

    For readers that expect those names. Files are renamed within their store, about twenty per task, each task
    reading no more than the first document of a file. A repeated attempt passes over what is already renamed.
    """
    goal = storage.qualified(files.sparkSession, target)
    opened, _, plain_folder = file_tools()

    def rename(batches):
        import hashlib
        import json

        from pyarrow import fs

        sink, base = opened(goal)
        for batch in batches:
            for folder, file in zip(batch["folder"], batch["file"]):
                source = f"{base}/{folder}/{file}"
                if not folder.startswith("table=") or sink.get_file_info(source).type == fs.FileType.NotFound:
                    continue
                head = b""
                with sink.open_input_stream(source, compression="gzip") as stream:
                    while b"\n" not in head:
                        piece = stream.read(1 << 16)
                        if not piece:
                            break
                        head += piece
                key = json.loads(head.split(b"\n", 1)[0])["~id"]
                plain = plain_folder(folder)
                sink.create_dir(f"{base}/{plain}", recursive=True)
                named = f"{base}/{plain}/{plain}-{hashlib.md5(key.encode('utf-8')).hexdigest()}.gz"
                if sink.get_file_info(named).type != fs.FileType.NotFound:
                    raise ValueError(f"two files of the snapshot would be named {named}; do two tables share its folder?")
                sink.move(source, named)
            yield batch[["table", "folder"]]

    def remove(batches):
        from pyarrow import fs

        sink, base = opened(goal)
        for batch in batches:
            for folder in batch["folder"]:
                if sink.get_file_info(f"{base}/{folder}").type == fs.FileType.Directory:
                    sink.delete_dir(f"{base}/{folder}")
            yield batch[["folder"]]

    renamed = stage(_spread(files).mapInPandas(rename, "table string, folder string"), "renamed", work)
    emptied = renamed.where(F.col("folder").startswith("table=")).select("folder").distinct()
    emptied.mapInPandas(remove, "folder string").count()
    return renamed.count()


def publish_snapshot(spark: SparkSession, root: str, name: str, attempts: int = 10, first_delay: float = 0.25) -> None:
    """Point ``_LATEST`` at a finished snapshot. Runs on the driver, where Spark does not retry, so it does so itself."""
    import time

    path = f"{root.rstrip('/')}/{POINTER_FILE}"
    for attempt in range(attempts):
        try:
            storage.write_small(spark, path, name)
            return
        except Exception:
            if attempt == attempts - 1:
                raise
            time.sleep(first_delay * 2**attempt)
