"""Schemas and constants shared by the batch and the streaming side.

Times inside the engine are whole epoch seconds in BIGINT columns, so no result
depends on the session time zone.
"""

from pyspark.sql import types as T

# Fixed values of the session model, in seconds.
GAP_SECONDS = 60
ALLOWED_LATENESS_SECONDS = 86_400
MAX_SKEW_SECONDS = 86_400
# An event time may run this far ahead of its arrival, and an arrival this far ahead of the wall clock.
MAX_AHEAD_SECONDS = 300
MINUTE_SECONDS = 60
# From the first change of a session to the pane that tells of it.
PANE_DELAY_SECONDS = 60

# Columns every message has after normalisation; `arrival` drives the watermark.
MESSAGE = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("message_name", T.StringType()),
    T.StructField("message_value", T.StringType()),
    T.StructField("event_sec", T.LongType()),
    T.StructField("arrival", T.TimestampType()),
])

# Counts are BIGINT: a hot session can pass 2^31 messages.
MESSAGE_COUNT = T.MapType(T.StringType(), T.LongType(), False)

SESSION = T.StructType([
    T.StructField("sessionId", T.StringType()),
    T.StructField("sessionLengthSeconds", T.IntegerType()),
    T.StructField("messageCount", MESSAGE_COUNT),
    T.StructField("session_start", T.LongType()),
])

# One restatement of a session as it leaves the stream; a dropped message has its second and the
# watermark that refused it.
REVISION = T.StructType(SESSION.fields + [
    T.StructField("pane", T.StringType()),
    T.StructField("late_sec", T.LongType()),
    T.StructField("watermark_ms", T.LongType()),
])

# Messages that came too late for their session, counted; `watermark_ms` refused them.
LATE_MESSAGE = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("message_name", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("event_sec", T.LongType()),
    T.StructField("watermark_ms", T.LongType()),
])

# What a micro-batch was observed to do, one row per figure.
BATCH_METRIC = T.StructType([
    T.StructField("observed", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

# Directory levels of the raw and the clean dataset, coarse to fine. The minute level
# needs a name of its own: Spark refuses one partition column name used twice.
PARTITION_LEVELS = {"year": "y", "month": "mo", "day": "d", "hour": "h", "minute": "mi"}

# Width in seconds of the finest directory a dataset may use. `minute` is the standard
# layout; a coarser one suits sparse data, where most minutes would hold a row or two.
GRAINS = {"day": 86_400, "hour": 3_600, "minute": 60}


def partition_columns(grain: str = "minute") -> list[str]:
    """Partition column names down to and including `grain`."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {list(GRAINS)}, not {grain!r}")
    levels = list(PARTITION_LEVELS)
    return [PARTITION_LEVELS[level] for level in levels[: levels.index(grain) + 1]]


def raw_schema(grain: str = "minute") -> T.StructType:
    """Raw dataset as read back: partition values stay strings, so their padding survives."""
    parts = [T.StructField(c, T.StringType()) for c in partition_columns(grain)]
    return T.StructType(
        SESSION.fields
        + [T.StructField("pane", T.StringType())]
        + parts
        + [T.StructField("rt", T.LongType())]
    )


def clean_schema(grain: str = "minute") -> T.StructType:
    """Clean dataset: receipt time is a data column there."""
    parts = [T.StructField(c, T.StringType()) for c in partition_columns(grain)]
    return T.StructType(SESSION.fields + [T.StructField("rt", T.LongType())] + parts)


NOTICE = T.StructType([T.StructField("event_time_second", T.LongType())])
