"""Final sessions by Spark's own session windows, without Python in the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.functions.event_time import instant
from tideline.model import ALLOWED_LATENESS_SECONDS, GAP_SECONDS, MAX_SKEW_SECONDS, MESSAGE_COUNT
from tideline.operators.guards import accepted
from tideline.operators.sessions import length_of


def native_final_sessions(
    messages: DataFrame,
    gap: int = GAP_SECONDS,
    lateness: int = ALLOWED_LATENESS_SECONDS,
    max_skew: int = MAX_SKEW_SECONDS,
) -> DataFrame:
    """One row per session (`model.SESSION`), once the greatest event time is past it; output mode append.

    The same rows as `final_sessions` with the event clock where no message is dropped: a session goes
    out when its last message, two gaps and the lateness lie behind. Spark merges spans that touch, so
    its windows end a microsecond before the gap. A window keeps the names of its messages until it
    closes, where the state operator keeps counts: for sessions of bounded length only.
    """
    good = accepted(messages, max_skew).withColumn("event_ts", instant(F.col("event_sec")))
    good = good.withWatermark("event_ts", f"{lateness + gap} seconds")
    window = F.session_window("event_ts", f"{gap - 1} seconds 999999 microseconds")
    sessions = good.groupBy(F.coalesce("session_id", F.lit("")).alias("sessionId"), window).agg(
        F.min("event_sec").alias("session_start"),
        F.max("event_sec").alias("last_sec"),
        F.sort_array(F.collect_list(F.coalesce("message_name", F.lit("")))).alias("names"),
    )
    # In sorted names a name's count is the distance from its first place to behind its last one.
    counts = F.map_from_entries(F.transform(
        F.array_distinct("names"),
        lambda name: F.struct(name, F.size(F.filter("names", lambda other: other == name)).cast("bigint")),
    ))
    return sessions.select(
        "sessionId",
        length_of(F.col("session_start"), F.col("last_sec")).alias("sessionLengthSeconds"),
        counts.cast(MESSAGE_COUNT).alias("messageCount"),
        "session_start",
    )
