"""Message sources: any table or file stream, brought to the columns of `model.MESSAGE`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.functions.event_time import epoch_seconds, epoch_seconds_ntz, instant
from tideline.model import MESSAGE


def normalise(
    df: DataFrame,
    session_id: str | Column,
    message_name: str | Column,
    event_time: str,
    message_value: str | Column | None = None,
    arrival: str | Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Map a table onto message columns; event time is cut to whole seconds.

    `event_time` names a TIMESTAMP, a TIMESTAMP_NTZ (read as UTC) or an epoch-second column.
    Without an arrival column the event time stands in for it. `keep` columns pass through.
    """
    kind = df.schema[event_time].dataType
    ts = F.col(event_time)
    if isinstance(kind, T.TimestampNTZType):
        event_sec = epoch_seconds_ntz(ts)
    elif isinstance(kind, T.TimestampType):
        event_sec = epoch_seconds(ts)
    else:
        event_sec = ts.cast("bigint")

    def column(c: str | Column | None) -> Column:
        return F.lit(None).cast("string") if c is None else F.col(c) if isinstance(c, str) else c

    return df.select(
        column(session_id).cast("string").alias("session_id"),
        column(message_name).cast("string").alias("message_name"),
        column(message_value).cast("string").alias("message_value"),
        event_sec.alias("event_sec"),
        (instant(event_sec) if arrival is None else column(arrival)).alias("arrival"),
        *keep,
    )


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of messages in the layout of `model.MESSAGE`."""
    return spark.read.schema(MESSAGE).format(fmt).load(path)


def stream_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", max_bytes_per_batch: int | None = None
) -> DataFrame:
    """File stream of messages; one micro-batch takes at most `max_bytes_per_batch` of files.

    A message without an arrival time counts as arrived when its file did.
    """
    reader = spark.readStream.schema(MESSAGE).format(fmt)
    if max_bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_batch))
    arrival = F.coalesce("arrival", F.col("_metadata.file_modification_time"))
    return reader.load(path).withColumn("arrival", arrival)


def stream_payloads(spark: SparkSession, **kafka_options: str) -> DataFrame:
    """Encoded messages from a Kafka topic (needs the Kafka connector on the class path).

    The broker's timestamp is the arrival time. Pass the result to `protobuf.decode_messages`.
    """
    stream = spark.readStream.format("kafka").options(**kafka_options).load()
    return stream.select(F.col("value").alias("payload"), F.col("timestamp").alias("arrival"))
