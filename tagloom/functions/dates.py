"""Dates and times, independent of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def compact_date(day: Column) -> Column:
    """``1992-05-31`` to ``19920531``."""
    return F.regexp_replace(day, "-", "")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a UTC timestamp without zone."""
    return F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def epoch_to_text(seconds: Column) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return F.date_format(epoch_to_timestamp(seconds), "yyyy-MM-dd HH:mm:ss")


def timestamp_to_epoch(ts: Column) -> Column:
    """Epoch seconds of a UTC timestamp without zone."""
    days = F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def reference_day(as_of: str | dt.date, shift_days: int = 0) -> Column:
    """The day recency is counted from: ``as_of`` moved back by ``shift_days``."""
    return F.date_sub(F.lit(str(as_of)).cast("date"), shift_days)


def days_since(ts: Column, as_of: str | dt.date, shift_days: int = 0) -> Column:
    """Whole days from ``ts`` to the reference day; negative when ``ts`` lies after it."""
    return F.datediff(reference_day(as_of, shift_days), ts)
