"""The change log: parquet, partitioned by poll day and table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schema import CHANGE_SCHEMA
from tidemark.sources import storage


def read_change_log(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """Scan with the fixed schema; nothing is inferred from the files or the directory names.

    With ``days`` only those days' directories are listed, however long the log's history is.
    """
    reader = spark.read.schema(CHANGE_SCHEMA)
    if days is None:
        return reader.parquet(path)
    base = path.rstrip("/")
    folders = [f"{base}/pollDate={day}" for day in days if storage.exists(spark, f"{base}/pollDate={day}")]
    if not folders:
        return spark.createDataFrame([], CHANGE_SCHEMA)
    return window_changes(reader.option("basePath", base).parquet(*folders), days)


def window_changes(changes: DataFrame, days: list[str]) -> DataFrame:
    """Changes of the given ``yyyyMMdd`` days; prunes directories when ``pollDate`` is a partition column."""
    return changes.where(F.col("pollDate").isin(days))


def filter_events(events: DataFrame, condition: str | None) -> DataFrame:
    """Keep the events a subscription asks for; ``condition`` is a Spark SQL predicate over their columns."""
    return events if not condition else events.where(F.expr(condition))
