"""What a compaction knows about the tables of the snapshot it wrote: ``<root>/_manifests/<snapshot>``, one row per table.

A merged table holds each document once, by construction. The next run relies on that and looks for repeated keys only in tables
that were never merged, so that it reads the text of the others once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import storage

MANIFEST_SCHEMA = "table string, unique boolean"


def manifest_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_manifests/{name}"


def read_manifest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``table, unique``; without a manifest nothing is known and the frame is empty."""
    path = manifest_path(root, name)
    if not storage.exists(spark, f"{path}/_SUCCESS"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def next_manifest(status: DataFrame, prior: DataFrame) -> DataFrame:
    """The manifest after a run: merged tables are unique, copied ones what they were before."""
    live = status.where(F.col("action").isin("merge", "copy")).select("table", "action")
    known = prior.select("table", "unique")
    joined = live.join(known, "table", "left")
    return joined.select("table", ((F.col("action") == "merge") | F.coalesce("unique", F.lit(False))).alias("unique"))


def write_manifest(manifest: DataFrame, root: str, name: str) -> None:
    manifest.write.mode("overwrite").parquet(manifest_path(root, name))
