"""Availability notices as text, and stable text for count maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tideline.model import NOTICE


def notice_json(event_time_second: Column) -> Column:
    """Compact JSON naming one event minute."""
    return F.to_json(F.struct(event_time_second.cast("bigint").alias("event_time_second")))


def envelope(text: Column) -> Column:
    """UTF-8 text in base64, the form in which a message bus hands over a payload."""
    return F.base64(F.encode(text, "utf-8"))


def open_envelope(data: Column) -> Column:
    """Inverse of `envelope`; null when the text is not base64."""
    return F.decode(F.try_to_binary(data, F.lit("base64")), "utf-8")


def notice_second(text: Column) -> Column:
    """Event second of a notice, plain JSON or in a base64 envelope; null when unreadable."""
    plain = F.from_json(text, NOTICE)["event_time_second"]
    wrapped = F.from_json(open_envelope(text), NOTICE)["event_time_second"]
    return F.when(F.startswith(F.ltrim(text), F.lit("{")), plain).otherwise(wrapped)


def counts_from_entries(name: Column, n: Column) -> Column:
    """Aggregate: one (name, n) row per name -> map sorted by name."""
    return F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, n))))


def counts_json(counts: Column) -> Column:
    """Count map as compact JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(counts))))


def total_messages(counts: Column) -> Column:
    """Number of messages behind a count map."""
    return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda a, v: a + v)
