"""Dates and times. Nothing here reads the clock: jobs take a ``run_ts``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(moment: dt.datetime, kind: str = "timestamp") -> Column:
    """A moment as a literal of the column's own type, so that a bound reaches the scan.

    UTC for a zone-free column and for a bare moment, whatever the session zone.
    """
    utc = moment.astimezone(dt.timezone.utc) if moment.tzinfo else moment
    mark = "" if kind == "timestamp_ntz" else "Z"
    return F.lit(f"{utc:%Y-%m-%d %H:%M:%S.%f}{mark}").cast(kind)


def one_hour() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def to_day(text: Column) -> Column:
    """Date of ``yyyy-MM-dd`` text, null where the text is none.

    The cast is several times faster than a pattern, but alone takes ``2024`` for a date.
    """
    return F.when(F.length(text) == 10, text.try_cast("date"))


def to_instant(text: Column, pattern: str) -> Column:
    """Timestamp in the given format, null where the text does not follow it."""
    return F.try_to_timestamp(text, F.lit(pattern))


def zoneless(text: Column) -> Column:
    """UTC stamp such as ``2024-01-01T23:00:00Z`` as a zone-free timestamp."""
    return F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz")


def at_zone(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a zone-free UTC timestamp, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def truncate(ts: Column, unit: str, kind: str = "timestamp") -> Column:
    """Start of the ``unit`` around ``ts``; ``date_trunc`` alone turns NTZ into a timestamp."""
    return F.date_trunc(unit, ts).cast(kind)


def day_parts(ts: Column) -> dict[str, Column]:
    """Padded year, month and day text, as used for partition folders."""
    return {
        "y": F.date_format(ts, "yyyy"),
        "m": F.date_format(ts, "MM"),
        "d": F.date_format(ts, "dd"),
    }


def folder_parts(ts: Column) -> dict[str, Column]:
    """Parts of a dated landing folder: year, month name, ISO day."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MMMM"),
        "day": F.date_format(ts, "yyyy-MM-dd"),
    }


def clock(hour: Column) -> Column:
    """``HH:00:00`` for a whole hour of day, null outside 0 to 23."""
    return F.when(hour.between(0, 23), F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")))


def clock_of(ts: Column) -> Column:
    """``HH:mm:ss`` of a zone-free timestamp, without a detour over the session zone."""
    return F.when(
        ts.isNotNull(),
        F.format_string("%02d:%02d:%02d", F.hour(ts), F.minute(ts), F.second(ts)),
    )


def epoch_millis(ts: Column, kind: str = "timestamp") -> Column:
    """Whole seconds since 1970 in milliseconds; the fraction is cut off.

    A zone-free column is taken as UTC, by its fields: a cast would go by the session zone.
    """
    if kind == "timestamp":
        return F.unix_seconds(ts) * 1000
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return ((days * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000 + F.second(ts) * 1000
