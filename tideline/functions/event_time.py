"""Conversions between instants and epoch seconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_seconds(ts: Column) -> Column:
    """TIMESTAMP -> whole epoch seconds (fractions are cut off)."""
    return F.unix_seconds(ts)


def epoch_seconds_ntz(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC -> whole epoch seconds."""
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def instant(seconds: Column) -> Column:
    """Epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(seconds)


def wall_clock_millis() -> Column:
    """Receipt time: one value per query, and per micro-batch in a stream, replays included."""
    return F.unix_millis(F.current_timestamp())


def floor_to(seconds: Column, width: int) -> Column:
    """Largest multiple of `width` not above `seconds`; right for times before 1970 too."""
    return seconds - F.pmod(seconds, F.lit(width).cast("bigint"))


def minute_of(seconds: Column) -> Column:
    """Start of the fixed one-minute window an epoch second falls into."""
    return floor_to(seconds, 60)
