"""A key's open sessions in state, ordered by start and cut into pages.

A key with up to `LEAF` open sessions has them in one value. Beyond that the value lists time pages
with the earliest time something is due in them, and each page is a map entry of its own. A batch
reads and writes that list and the pages its messages fall in, however many sessions the key has.
Numbers are packed as 64-bit values and the counts of a page are one JSON text: each is a single
field on its way to the state store, where nested rows would be converted field by field.
"""

from __future__ import annotations

import json
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

ROOT = "timer bigint, paged boolean, numbers binary, counts string"
PAGE_KEY, PAGE = "page bigint", "numbers binary, counts string"
# Sessions of one key start at least a gap apart, so a page this many gaps wide has at most as many.
LEAF = 32
NEVER = 2**62


@dataclass
class Session:
    start: int
    last: int
    fired: bool = False
    counts: dict[str, int] = field(default_factory=dict)
    # When a gathered pane is due, and the earliest arrival of a change not yet accounted for.
    pending: int | None = None
    changed: int | None = None

    def absorb(self, other: "Session") -> None:
        self.last = max(self.last, other.last)
        self.start = min(self.start, other.start)
        self.fired = self.fired or other.fired
        self.pending = earliest(self.pending, other.pending)
        self.changed = earliest(self.changed, other.changed)
        for name, n in other.counts.items():
            self.counts[name] = self.counts.get(name, 0) + n


def earliest(*times: int | None) -> int | None:
    return min((t for t in times if t is not None), default=None)


def numbers(rows: list[tuple[int, ...]]) -> bytes:
    return array("q", [x for row in rows for x in row]).tobytes()


def rows_of(packed: bytes, width: int) -> Iterator[tuple[int, ...]]:
    flat = array("q")
    flat.frombytes(packed)
    return zip(*(flat[k::width] for k in range(width)))


def pack(sessions: list[Session]) -> tuple[bytes, str]:
    rows = [(s.start, s.last, s.fired, NEVER if s.pending is None else s.pending) for s in sessions]
    return numbers(rows), json.dumps([s.counts for s in sessions], separators=(",", ":"))


def unpack(packed: bytes, counts: str) -> list[Session]:
    return [
        Session(start, last, bool(fired), held, None if pending == NEVER else pending)
        for (start, last, fired, pending), held in zip(rows_of(packed, 4), json.loads(counts), strict=True)
    ]


class SessionStore:
    """The sessions of the key at hand: pages are read when needed and what changed is saved once."""

    def __init__(self, root, pages, gap: int, due: Callable[[Session], int]) -> None:
        self.root, self.stored, self.gap, self.width, self.due = root, pages, gap, gap * LEAF, due
        found = root.get()
        self.timer, self.paged, packed, counts = found if found is not None else (None, False, b"", "[]")
        self.was_empty = found is None
        self.leaves: dict[int, list[Session]] = {} if self.paged else {0: unpack(packed, counts)}
        # The earliest time that something is due, by page; no page is empty.
        self.earliest = dict(rows_of(packed, 2)) if self.paged else {0: min(map(due, self.leaves[0]))} if self.leaves[0] else {}
        self.order = sorted(self.earliest)
        self.changed: set[int] = set()
        # What the root says of the pages, to see whether it has to be written again.
        self.listed = (self.timer, dict(self.earliest)) if self.paged else None

    def _page(self, second: int) -> int:
        return second // self.width if self.paged else 0

    def _leaf(self, page: int) -> list[Session]:
        if page not in self.leaves:
            self.leaves[page] = unpack(*self.stored.getValue((page,))) if page in self.earliest else []
        return self.leaves[page]

    def near(self, start: int, last: int) -> list[Session]:
        """Sessions that come closer than the gap to a span, in order: at most one begins before it."""
        found = []
        at = bisect_right(self.order, self._page(start)) - 1
        while at >= 0:
            leaf = self._leaf(self.order[at])
            before = bisect_right(leaf, start, key=lambda s: s.start) - 1
            if before >= 0:
                if start - leaf[before].last < self.gap:
                    found.append(leaf[before])
                break
            at -= 1  # no page is empty: one step back is enough
        for page in self.order[bisect_left(self.order, self._page(start)):]:
            if page > self._page(last + self.gap):
                break
            found += [s for s in self._leaf(page) if start < s.start < last + self.gap]
        return found

    def due_by(self, millis: int) -> list[Session]:
        """Sessions with something due, in order of start; reads only pages that hold one."""
        pages = [p for p in self.order if not self.paged or self.earliest[p] <= millis]
        return [s for p in pages for s in self._leaf(p) if self.due(s) <= millis]

    def add(self, session: Session) -> None:
        page = self._page(session.start)
        leaf = self._leaf(page)
        leaf.insert(bisect_left(leaf, session.start, key=lambda s: s.start), session)
        if page not in self.earliest:
            self.earliest[page] = 0
            self.order = sorted(self.earliest)
        self.changed.add(page)

    def remove(self, session: Session) -> None:
        page = self._page(session.start)
        leaf = self._leaf(page)
        del leaf[bisect_left(leaf, session.start, key=lambda s: s.start)]
        self.changed.add(page)
        if not leaf:
            del self.earliest[page]
            self.order.remove(page)

    def touch(self, session: Session) -> None:
        self.changed.add(self._page(session.start))

    def _split(self) -> None:
        """From one leaf in the root to pages."""
        sessions, self.paged, self.leaves = self.leaves[0], True, {}
        for s in sessions:
            self.leaves.setdefault(self._page(s.start), []).append(s)
        self.changed = set(self.leaves)
        self.earliest = dict.fromkeys(self.leaves, 0)

    def save(self, register: Callable[[int], None]) -> None:
        """Write what changed; `register` a timer if something is due before the one that is pending."""
        if not self.paged and len(self.leaves[0]) > LEAF:
            self._split()
        for page in self.changed:
            if self.leaves[page]:
                self.earliest[page] = min(map(self.due, self.leaves[page]))
                if self.paged:
                    self.stored.updateValue((page,), pack(self.leaves[page]))
            elif self.paged:
                self.stored.removeKey((page,))
        if not self.earliest:
            if not self.was_empty:
                self.root.clear()
            return
        first = min(self.earliest.values())
        if self.timer is None or first < self.timer:
            register(first)
            self.timer = first
        if not self.paged:
            self.root.update((self.timer, False, *pack(self.leaves[0])))
        elif self.listed != (self.timer, self.earliest):
            self.root.update((self.timer, True, numbers(sorted(self.earliest.items())), ""))

    def sessions(self) -> Iterator[Session]:
        """All sessions in order, for tests and inspection."""
        for page in self.order:
            yield from self._leaf(page)
