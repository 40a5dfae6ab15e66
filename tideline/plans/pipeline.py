"""Streaming jobs: sessions to the raw dataset with notices, and quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.model import MAX_SKEW_SECONDS
from tideline.operators.guards import quarantined
from tideline.sinks.notices import write_notices
from tideline.sinks.raw import touched_minutes, write_revisions
from tideline.streaming.revisions import session_revisions, with_receipt_time

EVERY_MINUTE = {"processingTime": "1 minute"}
UNTIL_DONE = {"availableNow": True}


def late_messages(batch: DataFrame) -> DataFrame:
    """The dropped messages of a micro-batch: how many of each (key, name, second), and the watermark that refused them."""
    return batch.where("pane = 'dropped'").select(
        F.col("sessionId").alias("session_id"),
        F.explode("messageCount").alias("message_name", "n"),
        F.col("late_sec").alias("event_sec"),
        "watermark_ms",
    )


def _sink(raw_root: str, notice_root: str | None, grain: str, late_root: str | None) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # Used several times below; recomputing it would run the state operator again.
        rows = batch.persist()
        try:
            dropped = F.col("pane") == "dropped"
            found = rows.agg(F.count_if(dropped).alias("dropped"), F.count_if(~dropped).alias("revisions")).first()
            if late_root and found["dropped"]:
                # One directory per micro-batch: a replay replaces it.
                late_messages(rows).write.mode("overwrite").parquet(f"{late_root}/batch_id={batch_id}")
            if not found["revisions"]:
                return
            revisions = rows.where(~dropped)
            write_revisions(revisions, raw_root, grain)
            if notice_root:
                # Only after the data is in place.
                write_notices(touched_minutes(revisions), notice_root, batch_id)
        finally:
            rows.unpersist()

    return write


def run_pipeline(
    messages: DataFrame,
    raw_root: str,
    notice_root: str | None,
    checkpoint: str,
    trigger: dict | None = None,
    grain: str = "minute",
    late_root: str | None = None,
    **session_options,
) -> StreamingQuery:
    """Start the job: streaming messages -> session revisions -> raw dataset -> notices.

    `session_options` go to `session_revisions` (gap, lateness, max_skew, clock, early, pane_delay).
    Without a `pane_delay` the trigger, by default one minute, is the delay of late and early panes.
    Messages too late for their session go to `late_root` (`model.LATE_MESSAGE`), from the same query.
    """
    revisions = with_receipt_time(session_revisions(messages, **session_options))
    return (
        revisions.writeStream.queryName("session-revisions")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .foreachBatch(_sink(raw_root, notice_root, grain, late_root))
        .start()
    )


def run_quarantine(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_skew: int = MAX_SKEW_SECONDS,
) -> StreamingQuery:
    """Start the job that keeps rejected messages, with the reason, instead of failing."""
    return (
        quarantined(messages, max_skew)
        .writeStream.queryName("session-quarantine")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", root)
        .format("parquet")
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )
