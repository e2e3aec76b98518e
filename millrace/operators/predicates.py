"""Filters whose null or boundary behaviour is easy to get wrong."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.dates import literal


def differs(value: Column, other) -> Column:
    """Null-safe ``<>``: a null differs from a value, so its row stays."""
    return ~value.eqNullSafe(other)


def present_and_nonzero(value: Column) -> Column:
    return value.isNotNull() & (value != 0)


def within_hour(ts: Column, start: Column) -> Column:
    """``[start, start + 1 hour)``."""
    return (ts >= start) & (ts < start + F.expr("INTERVAL 1 HOUR"))


def between_instants(
    ts: Column, start: dt.datetime, end: dt.datetime, kind: str = "timestamp"
) -> Column:
    """``[start, end)`` on literals, so that they reach the scan."""
    return (ts >= literal(start, kind)) & (ts < literal(end, kind))


def off_day(day: Column, expected: Column) -> Column:
    """True where the day is another one or missing."""
    return ~day.eqNullSafe(expected)
