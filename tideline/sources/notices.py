"""Availability notices as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions.codec import notice_second


def decode_notices(lines: DataFrame) -> DataFrame:
    """`value STRING`, JSON or base64 of JSON -> `event_time_second`, null when unreadable."""
    return lines.select(notice_second(F.col("value")).alias("event_time_second"))


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", "true").schema("value string").text(path)
    return decode_notices(lines)


def stream_notices(spark: SparkSession, path: str) -> DataFrame:
    """File stream of notices. A replayed batch replaces its files, hence the two options."""
    lines = (
        spark.readStream.schema("value string")
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
        .text(path)
    )
    return decode_notices(lines)
