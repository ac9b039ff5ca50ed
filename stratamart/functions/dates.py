"""Date parsing and calendar parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Text date formats accepted by automatic date detection.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy")


def try_date(text: Column) -> Column:
    """First accepted format that parses, else NULL."""
    return F.coalesce(*(F.try_to_date(text, f) for f in DATE_FORMATS))


def try_wall_clock(text: Column) -> Column:
    """Zone-free timestamp; a trailing zone mark is ignored, the wall clock kept."""
    return text.try_cast("timestamp_ntz")


def date_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def day_of_week(date: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(date) - 1


def is_weekend(date: Column) -> Column:
    return day_of_week(date).isin(0, 6)


def as_date(value: dt.date | str | Column) -> Column:
    """A caller's date argument (never the clock) as a date column."""
    if isinstance(value, Column):
        return value
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def second_boundaries(start: Column, end: Column) -> Column:
    """Number of whole-second boundaries crossed between two wall-clock timestamps."""
    def seconds(ts: Column) -> Column:
        # From the parts, so that no time zone gets in.
        days = F.datediff(ts.cast("date"), F.lit(dt.date(1970, 1, 1))).cast("long")
        return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)

    return seconds(end) - seconds(start)
