"""Replay of a recorded table as data that arrives in waves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.model import GAP_SECONDS, MESSAGE, SESSION
from tideline.operators.observe import record_metrics
from tideline.operators.sessions import session_metrics
from tideline.plans.notice_job import run_dedupe_on_notice
from tideline.plans.pipeline import UNTIL_DONE, run_pipeline
from tideline.session import STREAMING_CONF, settings, shared_dir
from tideline.sources.messages import stream_messages
from tideline.streaming.revisions import final_sessions, with_receipt_time

# All messages of a replay that one state partition takes, on average at most.
MESSAGES_PER_STATE = 250_000


def replay_revisions(messages: DataFrame, gap: int = GAP_SECONDS) -> DataFrame:
    """Revisions a two-wave arrival leaves behind (a column `wave`, 1 or 2), as a batch query.

    Wave 1 gives revision 1 of its sessions. Wave 2 restates, over all messages so far, each
    session that one of its messages belongs to.
    """
    first = session_metrics(messages.where("wave = 1"), gap)
    second = session_metrics(messages, gap, carry=["wave"]).where("wave = 2").drop("wave")
    return first.withColumn("rt", F.lit(1).cast("bigint")).unionByName(
        second.withColumn("rt", F.lit(2).cast("bigint"))
    )


def _land(messages: DataFrame, wave: int, landing: str) -> None:
    rows = messages.where(F.col("wave") == wave).select(*MESSAGE.fieldNames())
    rows.write.mode("append").parquet(landing)


def _streaming_conf(spark: SparkSession, messages: DataFrame) -> dict[str, str]:
    # State partitions are fixed at a query's first start: one per core, or two, three and so on for many messages. What
    # the timers of a partition give in a micro-batch is held in Python memory until the last one.
    cores = spark.sparkContext.defaultParallelism
    rounds = max(-(-messages.count() // (MESSAGES_PER_STATE * cores)), 1)
    return {**STREAMING_CONF, "spark.sql.shuffle.partitions": str(cores * rounds)}


def replay_stream(
    spark: SparkSession,
    messages: DataFrame,
    waves: int,
    grain: str = "day",
    dedupe_each_wave: bool = False,
    late_root: str | None = None,
    metrics_root: str | None = None,
    **session_options,
) -> tuple[str, str]:
    """Run the whole pipeline over messages that land wave by wave (column `wave`, from 1).

    The job stops and restarts from its checkpoint between waves. Returns the roots of the
    raw and, after the notice-driven deduplication, the clean dataset.
    """
    base = shared_dir(spark, "replay")
    landing, raw, notices, clean = (f"{base}/{d}" for d in ("landing", "raw", "notices", "clean"))
    with settings(spark, _streaming_conf(spark, messages)):
        for wave in range(1, waves + 1):
            _land(messages, wave, landing)
            query = run_pipeline(
                stream_messages(spark, landing), raw, notices, f"{base}/checkpoint-sessions",
                UNTIL_DONE, grain, late_root, **session_options,
            )
            query.awaitTermination()
            if metrics_root:
                record_metrics(query, metrics_root)
            if dedupe_each_wave or wave == waves:
                run_dedupe_on_notice(
                    spark, notices, raw, clean, f"{base}/checkpoint-dedupe", UNTIL_DONE, grain
                ).awaitTermination()
    return raw, clean


def replay_rows(
    spark: SparkSession, messages: DataFrame, waves: int, build: Callable[[DataFrame], DataFrame], output_mode: str = "update"
) -> DataFrame:
    """What a streaming plan emits over messages that land wave by wave, with the `batch_id` of each row."""
    base = shared_dir(spark, "replay-rows")
    landing, out = f"{base}/landing", f"{base}/rows"
    schemas = []

    def append(batch: DataFrame, batch_id: int) -> None:
        # One directory per micro-batch: a replay replaces it.
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with settings(spark, _streaming_conf(spark, messages)):
        for wave in range(1, waves + 1):
            _land(messages, wave, landing)
            rows = build(stream_messages(spark, landing))
            schemas.append(rows.schema)
            (
                rows.writeStream.outputMode(output_mode)
                .option("checkpointLocation", f"{base}/checkpoint")
                .trigger(**UNTIL_DONE)
                .foreachBatch(append)
                .start()
                .awaitTermination()
            )
    return spark.read.schema(T.StructType([*schemas[-1].fields, T.StructField("batch_id", T.LongType())])).parquet(out)


def replay_final(
    spark: SparkSession, messages: DataFrame, waves: int, **session_options
) -> DataFrame:
    """Final sessions of messages that land wave by wave, as a table."""
    rows = replay_rows(spark, messages, waves, lambda m: with_receipt_time(final_sessions(m, **session_options)))
    return rows.select(*SESSION.fieldNames())
