"""Bounded samples of labelled rows, the only rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def sample_by_class(rows: DataFrame, per_class: int) -> DataFrame:
    """Of ``rows`` (``id``, ``label``) the ``per_class`` ids of each label with the least hashes: a small frame of distinct ids.

    Only ids and labels are ranked, and Spark drops all but ``per_class`` rows of a label in each task before it shuffles
    them. Rows without an id or a label are left out; an id with several labels keeps the greatest.
    """
    known = rows.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id"), "id"))
    chosen = known.select("id", "label", rank.alias("n")).where(F.col("n") <= per_class).select("id", "label")
    schema = chosen.schema
    return rows.sparkSession.createDataFrame(chosen.collect(), schema)
