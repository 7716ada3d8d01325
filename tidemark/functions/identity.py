"""Update ids and table status bits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.schema import EXISTS, HAS_UPDATES

_UUID = r"^[0-9a-fA-F]{1,8}(-[0-9a-fA-F]{1,4}){3}-[0-9a-fA-F]{1,12}$"


def update_id(*parts: Column) -> Column:
    """UUID-shaped id of a change, from its own fields, so that a replay or redelivery repeats it."""
    # the length in front of each field keeps ('ab','c') and ('a','bc') apart
    fields = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in (p.cast("string") for p in parts)]
    return F.regexp_replace(
        F.md5(F.concat(*fields)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def is_update_id(text: Column) -> Column:
    return text.rlike(_UUID)


def parse_update_id(text: Column) -> Column:
    """The id in lower case; a malformed one fails the job."""
    return F.when(is_update_id(text), F.lower(text)).otherwise(
        F.raise_error(F.concat(F.lit("malformed update id "), F.coalesce(text, F.lit("null"))))
    )


def table_exists(status: Column) -> Column:
    return status.bitwiseAND(EXISTS) != 0


def has_updates(status: Column) -> Column:
    return status.bitwiseAND(HAS_UPDATES) != 0


def combine_status(*flags: Column) -> Column:
    """Bitwise or, a null counting as no bits."""
    combined = F.lit(0)
    for flag in flags:
        combined = combined.bitwiseOR(F.coalesce(flag, F.lit(0)))
    return combined
