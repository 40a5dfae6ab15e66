"""Reading the input tables and cutting lineage with written tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and lost with no executor."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column = "text") -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold_of(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds, F.lit(0))


def unused(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores in front until no column has it."""
    lowered = {x.lower() for x in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name
