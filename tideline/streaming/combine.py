"""Reduction of stream rows before the shuffle into the state operator.

A streaming plan has no stateless partial aggregation, so each task merges its Arrow
batches itself. A hot key then sends at most one row per (second, name) and task, not one
per message. The second is kept, since lateness is decided per message.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tideline.streaming.index import NEVER, rows_of

KEYS = ["session_id", "message_name", "event_sec"]
COMBINED = "session_id string, message_name string, event_sec bigint, n bigint"
ARROW = pa.schema([
    ("session_id", pa.string()), ("message_name", pa.string()), ("event_sec", pa.int64()), ("n", pa.int64()),
])
# With `first_ms`, when the first message of a row came in, for panes that gather changes.
TIMED = pa.field("first_ms", pa.int64())
# What a task buffers before it merges; bounds memory, not results.
BUFFERED_ROWS = 100_000
BUFFERED_BYTES = 32 << 20
# Rows of a key as one: their names as a JSON list, the other columns row by row as 64-bit numbers.
PACKED_MESSAGES = "session_id string, names string, numbers binary"
ROWS_PER_PACK = 4_096
# Tasks that pack the rows of one key, by their seconds.
PACKERS = 4


def _merge(tables: list[pa.Table]) -> pa.Table:
    # Batches from Spark mark columns as not nullable, merged ones do not: bring them together.
    timed = TIMED.name in tables[0].column_names
    schema = ARROW.append(TIMED) if timed else ARROW
    rows = pa.concat_tables([t.select(schema.names).cast(schema) for t in tables])
    merged = rows.group_by(KEYS, use_threads=False).aggregate([("n", "sum"), *([(TIMED.name, "min")] if timed else [])])
    merged = merged.rename_columns([c.removesuffix("_sum").removesuffix("_min") for c in merged.column_names])
    return merged.select(schema.names).cast(schema)


def _full(table: pa.Table | pa.RecordBatch, rows: int, size: int) -> bool:
    return table.num_rows + rows >= BUFFERED_ROWS or table.nbytes + size >= BUFFERED_BYTES


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if not _full(batch, rows, size):
            rows, size = rows + batch.num_rows, size + batch.nbytes
            continue
        merged = _merge(held)
        if _full(merged, merged.num_rows, merged.nbytes):
            # More than half is left: holding on to it would merge the same rows again and again.
            yield from merged.combine_chunks().to_batches()
            held, rows, size = [], 0, 0
        else:
            held, rows, size = [merged], merged.num_rows, merged.nbytes
    if held:
        yield from _merge(held).combine_chunks().to_batches()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What `_combine` gives, with a row for up to 4,096 rows of a key."""
    for rows in _combine(batches):
        rows = rows.take(pc.sort_indices(rows.column("session_id")))
        ids, names = rows.column("session_id"), rows.column("message_name").to_pylist()
        starts = np.flatnonzero(np.append(True, pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False))[: len(ids)])
        within = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        starts = np.flatnonzero(within % ROWS_PER_PACK == 0)
        numbers = np.stack([rows.column(c).fill_null(NEVER).to_numpy() for c in rows.schema.names[2:]], axis=1)
        bounds = list(pairwise([*starts.tolist(), len(ids)]))
        yield pa.record_batch({
            "session_id": ids.take(pa.array(starts)),
            "names": pa.array([json.dumps(names[a:b]) for a, b in bounds], pa.string()),
            "numbers": pa.array([numbers[a:b].tobytes() for a, b in bounds], pa.binary()),
        })


def unpacked_messages(rows: Iterable[tuple[str, str, bytes]], timed: bool) -> Iterator[tuple]:
    """The rows of `combine_messages` from those of `pack_messages`."""
    for key, names, packed in rows:
        for name, (second, n, *first) in zip(json.loads(names), rows_of(packed, 3 if timed else 2), strict=True):
            yield key, name, second, n, *(None if f == NEVER else f for f in first)


def _per_task(messages: DataFrame, clock: str | None) -> tuple[DataFrame, str]:
    narrow = messages.select(
        F.coalesce("session_id", F.lit("")).alias("session_id"),
        F.coalesce("message_name", F.lit("")).alias("message_name"),
        "event_sec",
        F.lit(1).cast("bigint").alias("n"),
        *([F.unix_millis(clock).alias(TIMED.name)] if clock else []),
    )
    combined = f"{COMBINED}, {TIMED.name} bigint" if clock else COMBINED
    return narrow.mapInArrow(_combine, combined), combined


def combine_messages(messages: DataFrame, clock: str | None = None) -> DataFrame:
    """Messages -> `session_id, message_name, event_sec, n`, and `first_ms` of a timestamp column `clock`.

    Merged once per task and once more after a shuffle on (key, second). This spreads a hot
    key over all tasks, so the one state task it ends up in gets about one row per second
    and name, whatever the number of messages and of tasks that read them.

    The result carries no watermark column, so Spark drops no row on its own: whether a
    message is too late is decided per session by the state operator.
    """
    per_task, combined = _per_task(messages, clock)
    return per_task.repartition("session_id", "event_sec").mapInArrow(_combine, combined)


def pack_messages(messages: DataFrame, clock: str | None = None) -> DataFrame:
    """The same rows packed by key (`PACKED_MESSAGES`), for `unpacked_messages`.

    Spark's worker takes about 12 microseconds for each row of four columns on its way into a state operator.
    The shuffle sends a key to four tasks by its seconds, so a key comes as about four rows a micro-batch.
    """
    per_task, _ = _per_task(messages, clock)
    spread = F.pmod("event_sec", F.lit(PACKERS))
    return per_task.repartition("session_id", spread).mapInArrow(_packed, PACKED_MESSAGES)
