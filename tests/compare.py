"""Side-by-side run of a registered query and its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import SparkSession


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"create view {name} as select * from '{path}'")
    result = con.sql(sql)
    return result.columns, result.fetchall()


def ordered(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def check(spark: SparkSession, name: str, sf_dir: str) -> int:
    """Assert equal column names and rows; return the row count."""
    import __spark_entry__ as contract

    df = contract.queries()[name](spark, sf_dir)
    columns, rows = sql_rows(sf_dir, contract.oracle_sql()[name])
    got = [tuple(row) for row in df.collect()]
    assert sorted(df.columns) == sorted(columns)
    left, right = ordered(df.columns, got), ordered(columns, rows)
    assert len(left) == len(right), f"{name}: {len(left)} rows, SQL has {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    assert not different, f"{name}: {len(different)} rows differ, first {different[0]}"
    return len(left)
