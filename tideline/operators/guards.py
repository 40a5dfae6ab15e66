"""Guards on incoming messages: bad rows are set aside with a reason, never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline.model import ALLOWED_LATENESS_SECONDS, GAP_SECONDS, MAX_AHEAD_SECONDS, MAX_SKEW_SECONDS


def rejection(max_skew: int = MAX_SKEW_SECONDS) -> Column:
    """Why a message cannot be used; null for a good one.

    A time ahead of its clock is refused like one too old: either could move a watermark past
    all good messages.
    """
    ahead_millis = MAX_AHEAD_SECONDS * 1_000
    age_millis = F.unix_millis("arrival") - F.col("event_sec") * 1_000
    return (
        F.when(F.col("event_sec").isNull(), "missing_timestamp")
        .when(F.unix_millis("arrival") > F.unix_millis(F.current_timestamp()) + ahead_millis, "arrival_ahead")
        .when(age_millis > max_skew * 1_000, "skew")
        .when(age_millis < -ahead_millis, "ahead")
    )


def accepted(messages: DataFrame, max_skew: int = MAX_SKEW_SECONDS) -> DataFrame:
    return messages.where(rejection(max_skew).isNull())


def quarantined(messages: DataFrame, max_skew: int = MAX_SKEW_SECONDS) -> DataFrame:
    """Rejected messages with the reason; decoded ones keep their `error` and `payload`."""
    reason = rejection(max_skew)
    if "error" in messages.columns:
        reason = F.when(F.col("error").isNotNull(), "undecodable").otherwise(reason)
    return messages.withColumn("reason", reason).where("reason is not null")


def over_late(
    watermark_sec: Column, gap: int = GAP_SECONDS, lateness: int = ALLOWED_LATENESS_SECONDS
) -> Column:
    """True when a message's own window had expired at the given watermark."""
    return F.col("event_sec") + (gap + lateness) <= watermark_sec
