"""Time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ntz(value) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def timestamp(text: str) -> Column:
    """A zone-free timestamp literal; compares with a column without casting the column."""
    return F.lit(text).cast("timestamp_ntz")


def year_start(year: int) -> Column:
    return timestamp(f"{year:04d}-01-01 00:00:00")


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 of the written time, whatever the session time zone."""
    since_epoch = _ntz(ts) - timestamp("1970-01-01 00:00:00")
    return since_epoch.cast("interval second").cast("long")


def seconds_between(start, end) -> Column:
    """Difference of the whole seconds of two timestamps; negative when ``end`` is earlier."""
    return epoch_seconds(end) - epoch_seconds(start)


def hours_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(3600)


def year_of(ts) -> Column:
    return F.year(_ntz(ts))


def is_weekend(ts) -> Column:
    """Saturday or Sunday (``weekday`` counts from Monday = 0)."""
    return F.weekday(_ntz(ts)) >= 5
