"""Removal of rows that a later revision made obsolete across event minutes.

A late message can move a session's start to an earlier minute or join two sessions that
were already written. The restated session then lies in another minute than the old row,
and the per-minute deduplication cannot see that the old row is obsolete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tideline.model import GAP_SECONDS


class Sweep:
    """Which rows of a key, taken in order of start, overlap a newer one.

    Of the spans open at a start it keeps those that no other outlasts and outranks. Open spans
    overlap each other, so only those of the newest receipt time are still undecided.
    """

    def __init__(self) -> None:
        self.key: str | None = None
        self.open: list[tuple[int, int]] = []  # (end, rt): ends rise, receipt times fall
        self.undecided: list[tuple[int, int, Held, int]] = []  # end, rt, batch, row

    def start_key(self, key: str | None) -> None:
        for _, _, held, _ in self.undecided:
            held.waiting -= 1
        self.key, self.open, self.undecided = key, [], []

    def take(self, start: int, end: int, rt: int, held: "Held", row: int) -> None:
        self.open = [x for x in self.open if x[0] > start]
        still = []
        for u in self.undecided:
            if u[0] > start and u[1] >= rt:
                still.append(u)
                continue
            u[2].waiting -= 1
            if u[0] > start:
                u[2].keep[u[3]] = False
        self.undecided = still
        if self.open and self.open[0][1] > rt:
            held.keep[row] = False
        else:
            held.waiting += 1
            self.undecided.append((end, rt, held, row))
        if not any(e >= end and r >= rt for e, r in self.open):
            self.open = sorted([x for x in self.open if x[0] > end or x[1] > rt] + [(end, rt)])


class Held:
    """A batch on its way: which rows stay, and how many are not decided yet."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.batch, self.waiting = batch, 0
        self.keep = np.ones(batch.num_rows, bool)


def _current(gap: int):
    """Filter of batches sorted by key and start; holds back a batch only while a row of it is undecided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, queue = Sweep(), []
        reach = None  # the key of the last row and the greatest end of that key so far
        for batch in batches:
            if not batch.num_rows:
                continue
            held = Held(batch)
            queue.append(held)
            keys = batch.column("sessionId")
            start = batch.column("session_start").to_numpy(zero_copy_only=False).astype(np.int64)
            end = start + gap + batch.column("sessionLengthSeconds").to_numpy(zero_copy_only=False).astype(np.int64)
            rt = batch.column("rt").to_numpy(zero_copy_only=False)
            same = np.zeros(len(start), bool)
            same[1:] = pc.equal(keys[1:], keys[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
            group = np.cumsum(~same)
            low = min(int(end.min()), reach[1] if reach else int(end.min()))
            # Running maxima of the ends, key by key: each key lies above the one before.
            lift = group * (int(end.max()) - low + 1)
            top = np.maximum.accumulate(end - low + lift) - lift + low
            first = keys[0].as_py()
            if reach and reach[0] == first:
                top = np.where(group == group[0], np.maximum(top, reach[1]), top)
            joins = np.zeros(len(start), bool)  # comes near an earlier row of its key
            joins[1:] = same[1:] & (start[1:] < top[:-1])
            joins[0] = bool(reach and reach[0] == first and start[0] < reach[1])
            alone = ~joins & ~np.append(joins[1:], False)
            alone[-1] = False  # what follows is not known yet
            reach = (keys[len(start) - 1].as_py(), int(top[-1]))
            for i in np.flatnonzero(~alone).tolist():
                if not joins[i]:
                    sweep.start_key(None)
                sweep.take(int(start[i]), int(end[i]), int(rt[i]), held, i)
            while queue and not queue[0].waiting:
                done = queue.pop(0)
                yield done.batch.filter(pa.array(done.keep))
        for done in queue:
            yield done.batch.filter(pa.array(done.keep))

    return run


def reconcile(rows: DataFrame, gap: int = GAP_SECONDS) -> DataFrame:
    """Drop each row that comes closer than the gap to a row of its key with a greater receipt time.

    One shuffle on the key and a sweep over its rows in order of start: nothing is joined and no pairs
    are formed. A task holds the spans open at one time, not the rows of a key. Rows of equal receipt
    time do not drop each other. Rows may come from any number of runs, in any overlap.
    """
    placed = rows.repartition("sessionId").sortWithinPartitions("sessionId", "session_start", F.desc("rt"))
    return placed.mapInArrow(_current(gap), rows.schema)
