"""Batch job: remove obsolete rows from the days that new revisions touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions.event_time import floor_to
from tideline.functions.partition_path import partition_path
from tideline.model import GAP_SECONDS, GRAINS, clean_schema, partition_columns
from tideline.operators.reconcile import reconcile
from tideline.sinks.raw import clustered, write_partitions
from tideline.sources.partitions import scan_days

DAY = GRAINS["day"]


def reconcile_days(
    spark: SparkSession,
    clean_root: str,
    minutes: DataFrame,
    grain: str = "minute",
    gap: int = GAP_SECONDS,
    span_days: int = 1,
) -> None:
    """Rewrite the days of the given minutes (a column `minute`), and what lies near them, without obsolete rows.

    A new revision of a day can make rows obsolete up to `span_days` away, the longest session; these
    days are rewritten too, and the rows that decide over them are read from as far again. All other
    days are neither read nor listed. Partitions are replaced where they lie; one that is left without
    rows is emptied.
    """
    touched = minutes.select(floor_to(F.col("minute"), DAY).alias("day")).distinct()
    offsets = F.explode(F.sequence(F.lit(-2 * span_days), F.lit(2 * span_days)))
    days = touched.select("day", offsets.alias("offset")).groupBy((F.col("day") + F.col("offset") * DAY).alias("day")).agg(
        F.min(F.abs("offset")).alias("distance")
    ).persist()
    try:
        rows = scan_days(spark, clean_root, days.select("day"), clean_schema(grain))
        if rows is None:
            return
        day = floor_to(F.col("session_start"), DAY)
        near = days.where(F.col("distance") <= span_days).select("day")
        kept = reconcile(rows, gap).withColumn("day", day).join(near, "day", "left_semi")
        kept = kept.withColumn("minute", floor_to(F.col("session_start"), GRAINS["minute"])).persist()
        columns = partition_columns(grain)
        path = partition_path(F.col("session_start"), grain).alias("path")
        before = rows.withColumn("day", day).join(near, "day", "left_semi").select(path).distinct()
        # Few: a partition loses its last row only where a merge moved a session out of it.
        emptied = [r.path for r in before.join(kept.select(path).distinct(), "path", "left_anti").collect()]
        write_partitions(clustered(kept, grain).select(*rows.columns), clean_root, columns)
        nothing = spark.createDataFrame([], rows.drop(*columns).schema)
        for gone in emptied:
            nothing.write.mode("overwrite").parquet(f"{clean_root}/{gone}")
        kept.unpersist()
    finally:
        days.unpersist()
