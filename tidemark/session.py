"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # zstd shuffles and spills less than lz4 for JSON payloads
    "spark.io.compression.codec": "zstd",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on, plus any ``extra`` ones."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting (its one machine is then the whole cluster); anywhere else a
    machine-local folder would be invisible to the other executors, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/tidemark-scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch area (or below ``folder`` in it) and read it back.

    Cuts lineage so that a lost executor costs one re-read, and gives the optimizer exact file sizes.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
