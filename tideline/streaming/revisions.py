"""Streaming sessions: messages in, session revisions out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.functions.event_time import instant, wall_clock_millis
from tideline.model import (
    ALLOWED_LATENESS_SECONDS,
    GAP_SECONDS,
    MAX_SKEW_SECONDS,
    SESSION,
)
from tideline.operators.guards import accepted
from tideline.operators.observe import observe_messages, observe_revisions
from tideline.streaming.combine import pack_messages
from tideline.streaming.processor import PACKED, PackedRevisions, unpacked


def session_revisions(
    messages: DataFrame,
    gap: int = GAP_SECONDS,
    lateness: int = ALLOWED_LATENESS_SECONDS,
    max_skew: int = MAX_SKEW_SECONDS,
    clock: str = "arrival",
    early: bool = False,
    final_only: bool = False,
    pane_delay: int = 0,
    output_mode: str = "Update",
) -> DataFrame:
    """Revisions of every session (`model.REVISION`) as a streaming DataFrame.

    `clock` names what moves the watermark: `arrival`, the time messages came in, or `event`,
    the greatest event time seen, for streams that record no arrival. With `pane_delay` (seconds
    of that clock), early and late panes gather the changes of that time, else each micro-batch
    that changes a session tells of it. `output_mode` is that of the query; state operators that
    follow need `Append`.
    """
    if clock not in ("arrival", "event"):
        raise ValueError(f"clock must be 'arrival' or 'event', not {clock!r}")
    clock_ts = F.col("arrival") if clock == "arrival" else instant(F.col("event_sec"))
    # Rejected before the watermark: a refused message must not move the clock.
    good = accepted(observe_messages(messages, max_skew), max_skew)
    good = good.withColumn("clock_ts", clock_ts).withWatermark("clock_ts", "0 seconds")
    revisions = (
        pack_messages(good, "clock_ts" if pane_delay else None)
        .groupBy("session_id")
        .transformWithState(
            PackedRevisions(gap, lateness, early, final_only, pane_delay),
            outputStructType=PACKED,
            outputMode=output_mode,
            timeMode="EventTime",
        )
    )
    return observe_revisions(unpacked(revisions))


def with_receipt_time(revisions: DataFrame) -> DataFrame:
    """Add `rt`, the same for all rows of a micro-batch and for its replays."""
    return revisions.withColumn("rt", wall_clock_millis())


def final_sessions(messages: DataFrame, **options) -> DataFrame:
    """One row per session, once no accepted message can change it any more."""
    return session_revisions(messages, final_only=True, **options).where("pane = 'final'").select(*SESSION.fieldNames())
