"""Poll days and the date window of a compaction. All days are UTC, whatever the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

from tidemark.functions.naming import as_utc
from tidemark.schema import POLL_DAY_FORMAT

_MICROS_PER_DAY = 86_400_000_000


def utc_day(when: Column) -> Column:
    """UTC calendar date of a timestamp."""
    micros = F.unix_micros(when)
    day = (micros - F.pmod(micros, F.lit(_MICROS_PER_DAY))) / F.lit(_MICROS_PER_DAY)
    return F.date_from_unix_date(day.cast("int"))


def poll_date(when: Column) -> Column:
    """``yyyyMMdd`` of a timestamp, UTC."""
    return F.date_format(utc_day(when), "yyyyMMdd")


def poll_dates(prior: Column, new: Column) -> Column:
    """Array of the ``yyyyMMdd`` days to read for a snapshot at ``new`` on top of one at ``prior``.

    The prior day is included whole; a ``new`` of exactly midnight leaves its own day out.
    """
    first = utc_day(prior)
    last = utc_day(F.timestamp_micros(F.unix_micros(new) - 1))
    days = F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))
    listed = F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))
    return F.when(first <= last, listed).otherwise(F.array().cast("array<string>"))


def window_days(prior: datetime, new: datetime, lookback_days: int = 0) -> list[str]:
    """Same as :func:`poll_dates` for two driver-side times.

    ``lookback_days`` starts the window earlier, for logs whose writers may lag past midnight of a compaction.
    """
    day = as_utc(prior).replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=lookback_days)
    end = as_utc(new)
    days = []
    while day < end:
        days.append(day.strftime(POLL_DAY_FORMAT))
        day += timedelta(days=1)
    return days


def check_snapshot_order(prior: datetime, new: datetime) -> None:
    if not as_utc(prior) < as_utc(new):
        raise ValueError(f"the new snapshot time {new} must be later than the latest snapshot's {prior}")
