"""Moving finished files to their places, in tasks."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from tidemark.schema import FILES_PER_COPY_TASK
from tidemark.sources import storage
from tidemark.sources.whole_files import file_tools


def move_files(spark: SparkSession, base: str, goal: str, label: str | None = None) -> int:
    """Move every file below ``base`` to the same folder below ``goal``, about twenty per task; returns how many there were.

    A file that is gone was moved by an earlier attempt of its task, so tasks can be repeated, and so can an interrupted move as a
    whole. With ``label`` a part file is renamed to ``part-<label>-<number of its task>``, else it keeps its name.
    """
    if not storage.exists(spark, base):
        return 0
    files = [(folder, file) for folder, file, _ in storage.files_below(spark, base) if not file.startswith(("_", "."))]
    if not files:
        return 0
    source_uri, goal_uri = storage.qualified(spark, base), storage.qualified(spark, goal)
    opened, *_ = file_tools()

    def move(batches):
        from pyarrow import fs

        for rows in batches:
            for folder, file in zip(rows["folder"], rows["file"]):
                store, source = opened(source_uri)
                _, target = opened(goal_uri)
                if store.get_file_info(f"{source}/{folder}/{file}").type == fs.FileType.NotFound:
                    continue
                # a task writes one file for each folder; its number tells the files of a folder apart
                named = f"part-{label}-{file.split('-')[1]}{file[file.index('.'):]}" if label else file
                store.create_dir(f"{target}/{folder}", recursive=True)
                store.move(f"{source}/{folder}/{file}", f"{target}/{folder}/{named}")
            yield rows[["file"]]

    listed = spark.createDataFrame(files, "folder string, file string")
    listed.repartition(max(1, -(-len(files) // FILES_PER_COPY_TASK))).mapInPandas(move, "file string").agg(F.count("file")).collect()
    return len(files)
