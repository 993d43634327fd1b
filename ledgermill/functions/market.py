"""Quote expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trend(change: Column) -> Column:
    return F.when(change > 0, "UP").when(change < 0, "DOWN").otherwise("STABLE")


def is_anomaly(change_percent: Column, volume: Column) -> Column:
    """Move above 5 % either way, or more than 100 million shares."""
    return (F.abs(change_percent) > 5) | (volume > 100_000_000)


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def day_of(ts: Column) -> Column:
    """Start of the day as a zone-free timestamp."""
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")
