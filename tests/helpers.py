"""Message fixtures and a brute-force sessionization to compare with."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession, functions as F

T0 = 1_704_067_200  # 2024-01-01 00:00:00 UTC

ROWS = "session_id string, message_name string, message_value string, event_sec bigint, arrival_sec bigint"


def message_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (session, name, event offset, arrival offset), offsets from T0; None stays null."""
    data = [(s, n, None, None if e is None else T0 + e, T0 + a) for s, n, e, a in rows]
    df = spark.createDataFrame(data, ROWS)
    return df.select(
        "session_id", "message_name", "message_value", "event_sec",
        F.timestamp_seconds("arrival_sec").alias("arrival"),
    )


def brute_force(rows: list[tuple], gap: int) -> set[tuple]:
    """Sessions of rows (key, name, second, ...) as (key, start, length, sorted counts)."""
    found = set()
    for key in {r[0] for r in rows}:
        run: list[tuple] = []
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: r[2]) + [None]:
            if run and (row is None or row[2] - run[-1][2] >= gap):
                counts = Counter(r[1] for r in run)
                found.add((key, run[0][2], run[-1][2] - run[0][2], tuple(sorted(counts.items()))))
                run = []
            run.append(row)
    return found


def as_set(sessions: DataFrame, offset: int = T0) -> set[tuple]:
    return {
        (r.sessionId, r.session_start - offset, r.sessionLengthSeconds,
         tuple(sorted(r.messageCount.items())))
        for r in sessions.collect()
    }
