"""The list of tables that exist now."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def live_tables_text(spark: SparkSession, path: str) -> DataFrame:
    """One table name per line."""
    return spark.read.text(path).where(F.col("value") != "").select(F.col("value").alias("table"))


def live_tables_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Available tables of a catalog dump, one JSON entry per line.

    An entry is available when its ``availability`` is an object (or array): null, missing and plain values
    are not. Read as a variant, so that a text which only looks like an object does not count.
    """
    entries = spark.read.schema("name string, availability variant").json(path)
    return available_tables(entries)


def available_tables(entries: DataFrame) -> DataFrame:
    kind = F.schema_of_variant(F.col("availability"))
    return entries.where(kind.startswith("OBJECT") | kind.startswith("ARRAY")).select(F.col("name").alias("table"))


def union_tables(*catalogs: DataFrame) -> DataFrame:
    """Names from several catalogs, all kept."""
    return reduce(DataFrame.unionByName, [c.select("table") for c in catalogs])
