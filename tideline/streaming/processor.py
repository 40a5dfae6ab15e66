"""State operator: merging sessions per key, with revisions for late data.

State holds the open sessions of a key with counts per name, never messages, in pages by time
(`streaming.index`): a batch reads and writes what lies near its messages, however many sessions
the key has open.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.model import REVISION
from tideline.streaming.combine import unpacked_messages
from tideline.streaming.index import PAGE, PAGE_KEY, ROOT, Session, SessionStore, earliest


def merge_sessions(sessions: Iterable[Session], gap: int) -> list[Session]:
    """Join sessions that come closer than the gap; spans that only meet stay apart."""
    merged: list[Session] = []
    for s in sorted(sessions, key=lambda s: s.start):
        if merged and s.start - merged[-1].last < gap:
            merged[-1].absorb(s)
        else:
            merged.append(s)
    return merged


class SessionRevisions(StatefulProcessor):
    """Emits a row per session when the watermark closes it and whenever it changes later.

    panes: `on_time` the watermark passed the session end; `late` a closed session changed
    (the row restates the whole session); `early` an open session changed (only with
    `early=True`); `final` the session can no longer change (only with `final_only=True`,
    which suppresses the others); `dropped` messages that came too late, with their event second
    and the watermark that refused them.

    With `pane_delay`, early and late panes gather: the first change after a pane marks the session,
    and one pane goes out when the watermark has passed that change's time by the delay. The time is
    that of the clock that moves the watermark, so a replay gives the same panes. A session that
    nobody has heard of and that is closed already goes out at once, like an on-time pane.
    """

    def __init__(self, gap: int, lateness: int, early: bool = False, final_only: bool = False, pane_delay: int = 0):
        self.gap = gap
        self.lateness = lateness
        self.early = early
        self.final_only = final_only
        self.pane_delay = pane_delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.root = handle.getValueState("sessions", ROOT)
        self.pages = handle.getMapState("pages", PAGE_KEY, PAGE)

    def close(self) -> None:
        pass

    # When things happen to a session, in milliseconds of the watermark.

    def _closes(self, s: Session) -> int:
        return (s.last + self.gap) * 1_000

    def _expires(self, s: Session) -> int:
        # A message accepted at the last moment can join a session that ended up to one gap
        # before it. Without the extra gap it would restart the session from nothing.
        return (s.last + 2 * self.gap + self.lateness) * 1_000

    def _due(self, s: Session) -> int:
        following = self._expires(s) if s.fired or self.final_only else self._closes(s)
        return earliest(s.pending, following)

    def _store(self) -> SessionStore:
        return SessionStore(self.root, self.pages, self.gap, self._due)

    def _row(self, key: tuple, s: Session, pane: str, late_sec: int | None = None, watermark: int | None = None) -> Row:
        return Row(
            sessionId=key[0], sessionLengthSeconds=s.last - s.start, messageCount=dict(s.counts),
            session_start=s.start, pane=pane, late_sec=late_sec, watermark_ms=watermark,
        )

    def _pane(self, s: Session, watermark: int) -> str:
        return "late" if self._closes(s) <= watermark else "early"

    def _merge(self, key: tuple, store: SessionStore, spans: list[Session], watermark: int) -> Iterator[Row]:
        """Join new spans with the sessions they come near, and settle each session that changed."""
        changed: dict[int, Session] = {}
        for joined in spans:
            # Sessions lie a gap apart, so what is near the span only is near the joined session.
            for s in store.near(joined.start, joined.last):
                changed.pop(s.start, None)
                if s.pending is not None and joined.changed is not None and s.pending <= joined.changed:
                    # This change came after the gathered pane was due: it belongs to the next one.
                    s.pending = None
                    yield self._row(key, s, self._pane(s, watermark))
                store.remove(s)
                s.absorb(joined)
                joined = s
            store.add(joined)
            changed[joined.start] = joined
        for _, s in sorted(changed.items()):
            yield from self._settle(key, s, watermark)

    def _settle(self, key: tuple, s: Session, watermark: int) -> Iterator[Row]:
        """What a changed session gives now, and what it waits for."""
        changed, s.changed = s.changed, None
        if self.final_only:
            return
        closed = self._closes(s) <= watermark
        if not closed and not self.early:
            s.fired, s.pending = False, None  # the on-time pane will tell
            return
        if self.pane_delay and changed is not None and (s.fired or not closed):
            s.fired = closed
            s.pending = earliest(s.pending, changed + self.pane_delay * 1_000)
            return
        s.fired, s.pending = closed, None
        yield self._row(key, s, "late" if closed else "early")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        # Spans of one second by arrival; all at once where panes do not gather.
        steps: dict[int | None, dict[int, dict[str, int]]] = {}
        dropped: dict[int, dict[str, int]] = {}
        for _, name, second, n, *first in rows:  # the columns of `combine_messages`
            late = (second + self.gap + self.lateness) * 1_000 <= watermark
            arrived = first[0] if first and self.pane_delay else None
            seconds = dropped if late else steps.setdefault(arrived, {})
            counts = seconds.setdefault(second, {})
            counts[name] = counts.get(name, 0) + n
        for second, counts in dropped.items():
            yield self._row(key, Session(0, 0, counts=counts), "dropped", second, watermark)
        if not steps:
            return
        store = self._store()
        for arrived in sorted(steps, key=lambda a: a or 0):
            spans = [Session(sec, sec, counts=counts, changed=arrived) for sec, counts in steps[arrived].items()]
            yield from self._merge(key, store, merge_sessions(spans, self.gap), watermark)
        store.save(self.handle.registerTimer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        store = self._store()
        store.timer = None
        for s in store.due_by(watermark):
            if not self.final_only:
                if not s.fired and self._closes(s) <= watermark:
                    s.fired, s.pending = True, None
                    yield self._row(key, s, "on_time")
                elif s.pending is not None and (s.pending <= watermark or self._expires(s) <= watermark):
                    s.pending = None
                    yield self._row(key, s, self._pane(s, watermark))
            if self._expires(s) <= watermark:
                if self.final_only:
                    yield self._row(key, s, "final")
                store.remove(s)
            else:
                store.touch(s)
        store.save(self.handle.registerTimer)


ROWS_PER_TEXT = 1_000


class PackedRevisions(SessionRevisions):
    """The same rows from those of `pack_messages`, up to 1,000 that a call gives as one JSON text; `unpacked` makes rows of it.

    Spark's worker holds what the timers of a partition give until the last one, and makes an Arrow batch of what
    each key gives. A text takes about a tenth of the memory of its rows and is a single field on its way.
    """

    def _packed(self, key: tuple, rows: Iterator[Row]) -> Iterator[Row]:
        while some := list(islice(rows, ROWS_PER_TEXT)):
            # Names are values, not field names, whose length readers of JSON limit.
            found = [
                {"l": length, "k": list(counts), "n": list(counts.values()), "s": start, "p": pane, "e": late, "w": watermark}
                for _, length, counts, start, pane, late, watermark in some
            ]
            yield Row(sessionId=key[0], revisions=json.dumps(found, separators=(",", ":")))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        messages = unpacked_messages(rows, bool(self.pane_delay))
        return self._packed(key, super().handleInputRows(key, messages, timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._packed(key, super().handleExpiredTimer(key, timerValues, expiredTimerInfo))


PACKED = "sessionId string, revisions string"
PACKED_REVISIONS = "array<struct<l:int,k:array<string>,n:array<bigint>,s:bigint,p:string,e:bigint,w:bigint>>"


def unpacked(packed: DataFrame) -> DataFrame:
    """Rows of `PackedRevisions` -> `model.REVISION`; a text that cannot be read is an error."""
    rows = F.from_json("revisions", PACKED_REVISIONS, {"mode": "FAILFAST"})
    return packed.select("sessionId", F.inline(rows)).select(
        "sessionId", F.col("l").alias("sessionLengthSeconds"), F.map_from_arrays("k", "n").alias("messageCount"),
        F.col("s").alias("session_start"), F.col("p").alias("pane"), F.col("e").alias("late_sec"),
        F.col("w").alias("watermark_ms"),
    ).select(*REVISION.fieldNames())
