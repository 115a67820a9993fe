"""Date columns. The as-of date is always a parameter, never the clock."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.builds import compact_day


def as_date(day: dt.date | str) -> dt.date:
    """A Python date from a date or a ``yyyy-MM-dd`` string."""
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def days_before(day: dt.date | str, days: int) -> dt.date:
    return as_date(day) - dt.timedelta(days=days)


def days_between(first: dt.date | str, last: dt.date | str) -> int:
    """Number of dates from ``first`` to ``last``, both counted."""
    return (as_date(last) - as_date(first)).days + 1


def days_since(day: Column, start: Column) -> Column:
    """Whole days from ``start`` to ``day``; NULL when either is."""
    return F.date_diff(day, start)


def days_ago(as_of: Column, days: int, compact: bool = True) -> Column:
    """The date ``days`` before, as ``yyyyMMdd`` or ``yyyy-MM-dd``."""
    day = F.date_sub(as_of, days)
    return compact_day(day) if compact else sql_date(day)


def sql_date(day: Column) -> Column:
    return day.cast("date").cast("string")


def epoch_ms(ms: Column, whole_seconds: bool = False) -> Column:
    """Milliseconds since 1970 as a UTC wall-clock timestamp, whatever the session zone."""
    ms = F.floor(ms / 1000) * 1000 if whole_seconds else ms
    return F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01").cast("timestamp_ntz"))
