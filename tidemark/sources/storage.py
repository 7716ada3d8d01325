"""Small driver-side file operations through Hadoop's file systems (pointer files, existence checks)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it."""
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def qualified(spark: SparkSession, path: str) -> str:
    """Path with scheme, as it shows up in ``_metadata.file_path``."""
    return file_system(spark, path).makeQualified(hadoop_path(spark, path)).toUri().toString().rstrip("/")


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file, without its end; empty if there is none."""
    stream = file_system(spark, path).open(hadoop_path(spark, path))
    jvm = spark._jvm
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def entries(spark: SparkSession, path: str) -> list[tuple[str, str, bool, int]]:
    """``(name, uri, is folder, bytes)`` of what lies directly in a folder, hidden names included."""
    found = file_system(spark, path).listStatus(hadoop_path(spark, path))
    return [(x.getPath().getName(), x.getPath().toUri().toString(), x.isDirectory(), x.getLen()) for x in found]


def files_below(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """``(folder below path, name, uri)`` of every file at any depth."""
    base = file_system(spark, path).makeQualified(hadoop_path(spark, path)).toUri().getPath().rstrip("/")
    found = file_system(spark, path).listFiles(hadoop_path(spark, path), True)
    files = []
    while found.hasNext():
        file = found.next().getPath()
        folder = file.getParent().toUri().getPath()
        files.append((folder.removeprefix(base).strip("/"), file.getName(), file.toUri().toString()))
    return files


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: write beside it, then rename over it."""
    jvm = spark._jvm
    target = hadoop_path(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{jvm.java.util.UUID.randomUUID()}")
    stream = file_system(spark, path).create(beside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()) \
        if target.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, target, options)
