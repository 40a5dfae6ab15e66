"""Event-driven deduplication: notices in, rewritten minutes out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.event_time import minute_of
from tideline.plans.dedupe_job import dedupe
from tideline.plans.pipeline import EVERY_MINUTE
from tideline.sources.notices import stream_notices


def run_dedupe_on_notice(
    spark: SparkSession,
    notice_root: str,
    raw_root: str,
    clean_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    grain: str = "minute",
) -> StreamingQuery:
    """Start the job. One query handles all notices, so no two rewrites of a minute race."""

    def rewrite(batch: DataFrame, batch_id: int) -> None:
        seconds = batch.where("event_time_second is not null")
        minutes = seconds.select(minute_of(F.col("event_time_second")).alias("minute")).distinct()
        minutes = minutes.persist()
        try:
            if not minutes.isEmpty():
                dedupe(batch.sparkSession, raw_root, minutes, clean_root, grain)
        finally:
            minutes.unpersist()

    return (
        stream_notices(spark, notice_root)
        .writeStream.queryName("dedupe-on-notice")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .foreachBatch(rewrite)
        .start()
    )
