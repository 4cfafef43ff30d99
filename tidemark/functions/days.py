"""Day and timestamp expressions, and the check of a day given as text."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def check_day(text: str | date) -> date:
    """A day as ``YYYY-MM-DD``; anything else is refused."""
    if isinstance(text, date):
        return text
    if not _DAY.fullmatch(text):
        raise ValueError(f"a day must look like YYYY-MM-DD, got {text!r}")
    return date.fromisoformat(text)


def check_range(first: str | date, last: str | date) -> tuple[date, date]:
    """An inclusive day range whose ends are in order."""
    first, last = check_day(first), check_day(last)
    if first > last:
        raise ValueError(f"first day {first} is after last day {last}")
    return first, last


def within(first: date, last: date) -> Column:
    """Partition filter of an inclusive day range."""
    return F.col("_dt").between(F.lit(first), F.lit(last))


def parsed_day(event_date: Column) -> Column:
    """Day of a ``YYYYMMDD`` text, NULL when malformed."""
    return F.try_to_date(event_date, "yyyyMMdd")


def event_day(event_date: Column, fallback: Column) -> Column:
    """Day of a ``YYYYMMDD`` text, the fallback day when malformed."""
    return F.coalesce(parsed_day(event_date), fallback)


def local_day(moment: Column, zone: str) -> Column:
    """Calendar day of a UTC moment in the property's time zone."""
    return F.to_date(F.from_utc_timestamp(moment, zone))
