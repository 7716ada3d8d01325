"""Where events go that cannot be stored: unreadable pages and documents without the required attributes, as they came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.metadata import METADATA_COLUMNS, is_complete
from tidemark.schema import INTRINSIC_FIELDS
from tidemark.sources import storage

# Columns of the table, without its partition columns ``query`` and ``batch``.
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("eventKey", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType(), False),
        T.StructField("pollDate", T.StringType(), False),
    ]
)
UNREADABLE_PAGE = "unreadable page"

# The attributes in the order of the columns that they give.
_ATTRIBUTES = dict(zip(METADATA_COLUMNS, INTRINSIC_FIELDS))


def rejection() -> Column:
    """Why an event of :func:`tidemark.streaming.events.parse_events` in mode ``keep`` cannot be stored; null if it can."""
    missing = [F.when(F.col(column).isNull(), F.lit(name)) for column, name in _ATTRIBUTES.items()]
    lacks = F.concat(F.lit("lacks "), F.concat_ws(", ", *missing))
    return F.when(F.col("unreadable"), F.lit(UNREADABLE_PAGE)).when(~is_complete(), lacks)


def split_rejected(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The events that can be stored, and those that cannot with their ``reason``."""
    judged = events.withColumn("reason", rejection())
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def batch_folder(path: str, query: str, batch: int) -> str:
    return f"{path.rstrip('/')}/query={query}/batch={batch}"


def write_quarantine(rejected: DataFrame, path: str, query: str, batch: int) -> None:
    """Write the rejected events of one micro-batch. Each has a folder of its own, so that a replay replaces what an earlier attempt left."""
    rows = rejected.select(*QUARANTINE_SCHEMA.fieldNames())
    rows.write.mode("overwrite").parquet(batch_folder(path, query, batch))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``eventKey, value, reason, pollDate, query, batch`` of all rejected events; nothing was rejected if the folder is missing."""
    schema = T.StructType([*QUARANTINE_SCHEMA.fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())])
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def requeue(quarantined: DataFrame, path: str) -> None:
    """Land quarantined events again, as pages that :func:`tidemark.streaming.events.landed_events` reads; a page that was unreadable goes as it is.

    Repair ``value`` first. The events come back as new deliveries: the newest pick takes care of those that were stored meanwhile.
    """
    event = F.to_json(F.struct("eventKey"))
    page = F.concat(F.lit("["), F.expr("substr(event, 1, length(event) - 1)"), F.when(F.col("eventKey").isNotNull(), F.lit(",")).otherwise(F.lit("")), F.lit('"content":'), F.coalesce("value", F.lit("null")), F.lit("}]"))
    pages = quarantined.withColumn("event", event).select(F.when(F.col("reason") == UNREADABLE_PAGE, F.col("value")).otherwise(page).alias("value"))
    pages.write.mode("append").text(path)
