"""Change events as they arrive: one JSON array of ``{"eventKey", "content"}`` per line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.metadata import require_complete, valid_documents, with_metadata

ENVELOPE = "array<struct<eventKey:string,content:string>>"


def landed_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over landed envelope files. Replayable, so a checkpointed query loses nothing on restart."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def union_streams(*streams: DataFrame) -> DataFrame:
    """All events of several equal-shaped streams (or frames)."""
    return reduce(DataFrame.unionByName, streams)


def parse_envelopes(lines: DataFrame, on_invalid: str = "fail") -> DataFrame:
    """``eventKey, value`` per event; ``value`` is the content object as compact JSON. Other fields are skipped.

    A line that is not blank and not such an array is never passed over in silence: ``fail`` stops, ``keep`` gives a row
    without ``eventKey`` and with the raw line as ``value``, and marks all rows by ``unreadable``; ``drop`` leaves it out. An
    empty array holds no events.
    """
    check_on_invalid(on_invalid)
    pages = lines.where(F.trim("value") != "").select("value", F.from_json("value", ENVELOPE).alias("events"))
    if on_invalid == "drop":
        pages = pages.where(F.col("events").isNotNull())
    raw = F.array(F.struct(F.lit(None).cast("string").alias("eventKey"), F.col("value").alias("content")))
    if on_invalid == "fail":
        message = F.concat(F.lit("unreadable page of events: "), F.substring("value", 1, 200))
        raw = F.raise_error(message).cast(ENVELOPE)
    events = pages.select(F.explode(F.coalesce("events", raw)).alias("event"), F.col("events").isNull().alias("unreadable"))
    mark = ["unreadable"] if on_invalid == "keep" else []
    return events.select("event.eventKey", F.col("event.content").alias("value"), *mark)


def check_on_invalid(on_invalid: str) -> None:
    if on_invalid not in ("fail", "drop", "keep"):
        raise ValueError(f"on_invalid must be fail, drop or keep, not {on_invalid!r}")


def parse_events(lines: DataFrame, on_invalid: str = "fail") -> DataFrame:
    """Envelope lines to ``eventKey, value, table, key, version, lastUpdateTs, deleted``.

    ``on_invalid``: ``fail`` stops on an unreadable page or a document without the required attributes, ``drop`` leaves
    it out, ``keep`` passes it on for :func:`tidemark.sinks.quarantine.split_rejected`.
    """
    events = with_metadata(parse_envelopes(lines, on_invalid))
    if on_invalid == "fail":
        return require_complete(events)
    if on_invalid == "drop":
        return valid_documents(events)
    return events
