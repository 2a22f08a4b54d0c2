"""Column expressions on time. Epoch seconds and epoch milliseconds are kept apart by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_epoch_seconds(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def bucket_of_epoch_millis(millis: Column, pattern: str = "yy-MM-dd|HH") -> Column:
    """Formatted time bucket. The argument is milliseconds and is read as milliseconds."""
    return F.date_format(F.timestamp_millis(millis), pattern)


def instant(ts: Column) -> Column:
    """Time-zone-free timestamp → instant, which watermarks need (session zone is UTC)."""
    return ts.cast("timestamp")


def wall(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")
