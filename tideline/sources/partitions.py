"""Scans of event-minute partitions that list only the directories they need."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.functions.event_time import minute_of
from tideline.functions.partition_path import (
    legacy_partition_path,
    partition_path,
    partition_values,
    receipt_of_path,
    try_path_to_second,
)
from tideline.model import GRAINS, PARTITION_LEVELS, SESSION, partition_columns, raw_schema
from tideline.session import settings

# Above this many directories a scan lists the next coarser level and filters the rest.
MAX_LISTED_PATHS = 1_000
# Which partitions there are is known from the listing; no file has to be opened for it.
FROM_THE_LISTING = {"spark.sql.optimizer.metadataOnly": "true"}
# However few directories are named, one job lists them and all below.
IN_ONE_JOB = {"spark.sql.sources.parallelPartitionDiscovery.threshold": "0"}
# Files of an event minute are small: many of them to a task, not the four that Spark's own 4 MB a file give.
MANY_FILES = {"spark.sql.files.openCostInBytes": "64k"}


def seconds_frame(spark: SparkSession, seconds: list[int]) -> DataFrame:
    """Given event seconds as a DataFrame of distinct event minutes."""
    rows = spark.createDataFrame([(int(s),) for s in seconds], "s bigint")
    return rows.select(minute_of(F.col("s")).alias("minute")).distinct()


def scan_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Whole dataset; predicates on the partition columns prune directories.

    Directories of minutes are listed by one job over all hours. From the root, Spark would list level
    by level on the driver and run a job for each hour.
    """
    reader = spark.read.schema(schema)
    if PARTITION_LEVELS["minute"] in schema.fieldNames():
        hours = "/".join(f"{name}=*" for name in partition_columns("hour"))
        try:
            with settings(spark, IN_ONE_JOB):
                return reader.option("basePath", root).parquet(f"{root}/{hours}")
        except AnalysisException as error:
            # No hour yet.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return reader.parquet(root)


def _listing(minutes: DataFrame, grain: str) -> tuple[str, list[str]]:
    """Level and names of the directories to list.

    Takes the finest level that stays under the limit, so the driver receives at most
    MAX_LISTED_PATHS names, or one per calendar day at the coarsest.
    """
    levels = list(GRAINS)[: list(GRAINS).index(grain) + 1]
    for level in reversed(levels):
        paths = minutes.select(partition_path(F.col("minute"), level).alias("p")).distinct()
        if level != "day":
            paths = paths.limit(MAX_LISTED_PATHS + 1)
        found = sorted(row.p for row in paths.collect())
        if level == "day" or len(found) <= MAX_LISTED_PATHS:
            return level, found


def scan_partitions(
    spark: SparkSession,
    root: str,
    minutes: DataFrame,
    grain: str = "minute",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of every partition that contains one of `minutes` (a column `minute`).

    With a coarser grain a partition also holds other minutes; these rows come along, since
    whoever rewrites the partition needs them. A directory that does not exist is an error,
    however many were asked for.
    """
    level, paths = _listing(minutes, grain)
    reader = spark.read.schema(schema or raw_schema(grain))
    if not paths:
        return reader.parquet(root).limit(0)
    rows = reader.option("basePath", root).parquet(*[f"{root}/{p}" for p in paths])
    if level == grain:
        return rows
    # More was listed than asked for: keep the wanted partitions and no others.
    names = partition_columns(grain)
    types = {f.name: f.dataType for f in rows.schema}
    values = [v.cast(types[n]).alias(n) for v, n in zip(partition_values(F.col("minute"), grain), names, strict=True)]
    wanted = minutes.select(*values).distinct()
    with settings(spark, FROM_THE_LISTING):
        absent = wanted.join(rows.select(*names).distinct(), names, "left_anti").first()
    if absent:
        path = "/".join(f"{n}={absent[n]}" for n in names)
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {root}/{path}")
    return rows.join(wanted, names, "left_semi").select(rows.columns)


def scan_days(spark: SparkSession, root: str, days: DataFrame, schema: T.StructType) -> DataFrame | None:
    """Rows of the given days (a column `day`, its first second) as far as they exist; None if none does.

    Only directories of these days are listed. The driver receives one name per day.
    """
    names = [r.p for r in days.select(partition_path(F.col("day"), "day").alias("p")).distinct().sort("p").collect()]
    if not names:
        return None
    try:
        # Alternatives of a pattern may be missing, paths given one by one may not.
        return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/{{{','.join(names)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# Directory names of the older layout that lead to an hour and to a day.
LEGACY_LEVELS = {"minute": 5, "hour": 4, "day": 3}


def _legacy_listing(minutes: DataFrame) -> tuple[str, list[str]]:
    """Like `_listing`, for the older layout."""
    full = legacy_partition_path(F.col("minute"))
    for level, names in LEGACY_LEVELS.items():
        paths = minutes.select(F.substring_index(full, "/", names).alias("p")).distinct()
        if level != "day":
            paths = paths.limit(MAX_LISTED_PATHS + 1)
        found = sorted(row.p for row in paths.collect())
        if level == "day" or len(found) <= MAX_LISTED_PATHS:
            return level, found


def scan_legacy_minutes(
    spark: SparkSession, root: str, minutes: DataFrame, schema: T.StructType = SESSION
) -> DataFrame:
    """Event minutes of a dataset in the older layout, whose paths use `m=` twice.

    Spark cannot discover such partitions from the root, so directories are read as plain files and
    `minute` and `rt` come from each file's path. Up to MAX_LISTED_PATHS directories are named one by
    one; beyond that whole hours or days are listed and files of other minutes are left out by a
    semi-join on the minute of their path. A minute that does not exist is an error either way.
    """
    stored = [f for f in schema.fields if f.name != "session_start"]
    level, paths = _legacy_listing(minutes)
    reader = spark.read.schema(T.StructType(stored)).option("recursiveFileLookup", "true")
    path = F.col("_metadata.file_path")
    if not paths:
        empty = T.StructType([*stored, T.StructField("minute", T.LongType()), T.StructField("rt", T.LongType())])
        return spark.createDataFrame([], empty)
    rows = reader.parquet(*[f"{root}/{p}" for p in paths]).select(
        *[f.name for f in stored],
        try_path_to_second(path).alias("minute"),
        receipt_of_path(path).alias("rt"),
    )
    if level == "minute":
        return rows
    wanted = minutes.select("minute").distinct()
    absent = wanted.join(rows.select("minute").distinct(), "minute", "left_anti").select(
        legacy_partition_path(F.col("minute")).alias("p")).first()
    if absent:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {root}/{absent['p']}")
    return rows.join(wanted, "minute", "left_semi").select(rows.columns)


def register_view(rows: DataFrame, name: str = "wanted_sessions") -> DataFrame:
    """Make a scan available to SQL under a view name."""
    rows.createOrReplaceTempView(name)
    return rows
