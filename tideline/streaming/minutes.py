"""Fixed one-minute windows of the session start, as a second state operator behind the sessions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.event_time import minute_of

MINUTE_TOTALS = T.StructType([
    T.StructField("minute_second", T.LongType()),
    T.StructField("sessions", T.LongType()),
    T.StructField("total_seconds", T.LongType()),
])


class MinuteTotals(StatefulProcessor):
    """Restates a minute's totals in each micro-batch that adds sessions to it. State: two numbers a minute."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "sessions bigint, total_seconds bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sessions, seconds = self.totals.get() or (0, 0)
        for row in rows:
            sessions, seconds = sessions + row["sessions"], seconds + row["total_seconds"]
        self.totals.update((sessions, seconds))
        yield Row(minute_second=key[0], sessions=sessions, total_seconds=seconds)


def minute_totals(finals: DataFrame) -> DataFrame:
    """Streaming final sessions -> accumulated `MINUTE_TOTALS` per minute of the session start.

    From here on a session's time is its start: it keys the second operator. Spark refuses event times
    behind the watermark, and a final session starts at least two gaps and the lateness behind it; so
    the minute is the key of a state of its own rather than a window on the watermark. Sessions come
    once each, so totals only grow; the row with the greatest receipt time of a minute holds.
    """
    per_session = finals.select(
        minute_of(F.col("session_start")).alias("minute_second"),
        F.lit(1).cast("bigint").alias("sessions"),
        F.col("sessionLengthSeconds").cast("bigint").alias("total_seconds"),
    )
    return per_session.groupBy("minute_second").transformWithState(
        MinuteTotals(), outputStructType=MINUTE_TOTALS, outputMode="Append", timeMode="None"
    )
