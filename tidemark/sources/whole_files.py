"""Tasks that handle whole files, through Arrow's file systems: no Spark call copies or renames files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.naming import RESERVED_IN_FOLDERS
from tidemark.schema import FILES_PER_COPY_TASK


def file_tools():
    """Functions for tasks that handle whole files. Nested, so that they travel to the executors by value."""
    reserved = RESERVED_IN_FOLDERS

    def opened(uri):
        from urllib.parse import quote, unquote

        from pyarrow import fs

        # Arrow knows the stores by their plain scheme names and wants reserved characters escaped
        scheme, _, rest = uri.partition(":")
        scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        rest = rest if rest.startswith("//") else "//" + rest
        return fs.FileSystem.from_uri(f"{scheme}:{quote(unquote(rest), safe='/:@~=')}")

    def partition_folder(name):
        if name.startswith("table="):
            return name
        return "table=" + "".join(f"%{ord(c):02X}" if c in reserved or ord(c) < 32 else c for c in name)

    def plain_folder(name):
        from urllib.parse import unquote

        return unquote(name[len("table="):]) if name.startswith("table=") else name

    return opened, partition_folder, plain_folder


def copy_renamed(files: DataFrame, goal: str) -> DataFrame:
    """Copy ``path`` to ``goal/table=<folder>/<file>`` for each row of ``folder, path, file``; lazy, one row per file."""
    opened, partition_folder, _ = file_tools()

    def copy(batches):
        from pyarrow import fs

        for batch in batches:
            for folder, path, file in zip(batch["folder"], batch["path"], batch["file"]):
                source, source_path = opened(path)
                sink, base = opened(goal)
                folder_path = f"{base}/{partition_folder('table=' + folder) if '=' not in folder else folder}"
                sink.create_dir(folder_path, recursive=True)
                fs.copy_files(source_path, f"{folder_path}/{file}", source_filesystem=source, destination_filesystem=sink)
            yield batch[["folder", "file"]]

    tasks = max(1, -(-files.count() // FILES_PER_COPY_TASK))
    return files.repartition(tasks).mapInPandas(copy, "folder string, file string")
