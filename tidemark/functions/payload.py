"""Payload encodings of the change log: UTF-8 text. Rows in any other encoding fail the job that reads them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.schema import TEXT


def text_to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def bytes_to_text(payload: Column) -> Column:
    return F.decode(payload, "UTF-8")


def decode_payload(encoding: Column, payload: Column) -> Column:
    """Text of a payload, chosen by its encoding code; any other code fails the job."""
    return F.when(encoding == TEXT, bytes_to_text(payload)).otherwise(
        F.raise_error(F.concat(F.lit("unsupported encoding code "), encoding.cast("string")))
    )
