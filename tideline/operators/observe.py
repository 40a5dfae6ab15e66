"""Stream metrics, computed inside the running query instead of logging rows."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tideline.functions.codec import total_messages
from tideline.model import BATCH_METRIC
from tideline.operators.guards import rejection

MESSAGES = "messages"
REVISIONS = "revisions"


def observe_messages(messages: DataFrame, max_skew: int) -> DataFrame:
    """Rows seen, rows rejected, and the range of event times, per micro-batch."""
    return messages.observe(
        MESSAGES,
        F.count(F.lit(1)).alias("rows"),
        F.count(rejection(max_skew)).alias("rejected"),
        F.min("event_sec").alias("first_event_sec"),
        F.max("event_sec").alias("last_event_sec"),
    )


def observe_revisions(revisions: DataFrame) -> DataFrame:
    """Revisions per pane, messages dropped as too late, and the range of session starts."""
    panes = [
        F.count_if(F.col("pane") == name).alias(name) for name in ("early", "on_time", "late", "final")
    ]
    dropped = total_messages(F.col("messageCount"))
    start = F.when(F.col("pane") != "dropped", F.col("session_start"))
    return revisions.observe(
        REVISIONS,
        *panes,
        F.sum(F.when(F.col("pane") == "dropped", dropped).otherwise(0)).alias("dropped_messages"),
        F.min(start).alias("first_start_sec"),
        F.max(start).alias("last_start_sec"),
    )


def observed(query, name: str) -> list[dict]:
    """Metrics of the query's recent micro-batches."""
    rows = (p.observedMetrics.get(name) for p in query.recentProgress)
    return [r.asDict() for r in rows if r is not None]


def batch_metrics(progress) -> list[tuple[str, str, int]]:
    """(observed, metric, value) of one micro-batch's progress."""
    return [
        (name, metric, value)
        for name, row in progress.observedMetrics.items() for metric, value in row.asDict().items()
    ]


def write_metrics(spark: SparkSession, progress, root: str) -> None:
    """Keep the figures of a micro-batch in its own directory; the same batch run again replaces it."""
    rows = batch_metrics(progress)
    if rows:
        schema = "observed string, metric string, value bigint"
        path = f"{root}/query={progress.name}/batch_id={progress.batchId}"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def record_metrics(query: StreamingQuery, root: str) -> None:
    """Keep the figures of the micro-batches a query still remembers, for one that has ended."""
    for progress in query.recentProgress:
        write_metrics(SparkSession.active(), progress, root)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """All figures kept, `model.BATCH_METRIC`."""
    return spark.read.schema(BATCH_METRIC).parquet(root)


class MetricsTable(StreamingQueryListener):
    """Keeps the figures of every micro-batch as rows; add it with `spark.streams.addListener`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        write_metrics(self.spark, event.progress, self.root)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class ProgressLog(StreamingQueryListener):
    """Logs the metrics above once per micro-batch; add it with `spark.streams.addListener`."""

    def __init__(self, logger: logging.Logger | None = None):
        self.logger = logger or logging.getLogger("tideline.progress")

    def onQueryStarted(self, event) -> None:
        self.logger.info("%s started", event.name)

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            self.logger.info("%s batch %s %s %s", event.progress.name, event.progress.batchId, name, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.logger.info("query %s ended", event.id)
