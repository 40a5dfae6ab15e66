"""The state operator by itself, driven batch by batch without a stream."""

from __future__ import annotations

import random

import pytest
from helpers import brute_force
from hypothesis import example, given, settings, strategies as st

from tideline.streaming.index import LEAF
from tideline.streaming.processor import Session, SessionRevisions, merge_sessions

GAP, LATENESS = 60, 3_600


class State:
    """A value or map state variable, counting its calls."""

    def __init__(self):
        self.value, self.map, self.calls, self.bytes = None, {}, 0, 0

    def _called(self, payload=()):
        self.calls += 1
        self.bytes += sum(len(x) if isinstance(x, (bytes, str)) else 8 for x in payload or ())

    def get(self):
        self._called(self.value)
        return self.value

    def update(self, value):
        self._called(value)
        self.value = value

    def clear(self):
        self._called()
        self.value = None

    def getValue(self, key):
        self._called(self.map.get(key))
        return self.map.get(key)

    def updateValue(self, key, value):
        self._called(value)
        # What comes back later does not change with what the operator holds.
        self.map[key] = tuple(dict(x) if isinstance(x, dict) else x for x in value)

    def removeKey(self, key):
        self._called()
        del self.map[key]


class Harness:
    """One key's state, timers and watermark."""

    def __init__(self, gap=GAP, lateness=LATENESS, **options):
        self.states, self.timers, self.watermark = {}, set(), 0
        self.operator = SessionRevisions(gap, lateness, **options)
        self.operator.init(self)

    # handle and timer values in one object
    def getValueState(self, name, schema):
        return self.states.setdefault(name, State())

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, State())

    @property
    def open(self):
        """Starts of the sessions in state, which lie a gap apart; pages listed and pages stored must agree."""
        store = self.operator._store()
        found = list(store.sessions())
        assert all(a.last + self.operator.gap <= b.start for a, b in zip(found, found[1:]))
        assert {k for k, in self.states["pages"].map} == (set(store.earliest) if store.paged else set())
        if store.paged:
            assert all(store.earliest[p] == min(map(store.due, store._leaf(p))) for p in store.order)
        return [s.start for s in found]

    def empty(self):
        return not self.open and self.states["sessions"].value is None and not self.states["pages"].map

    def registerTimer(self, millis):
        self.timers.add(millis)

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def _rows(self, rows):
        return [(r.pane, r.session_start, r.sessionLengthSeconds, dict(r.messageCount)) for r in rows]

    def batch(self, *messages):
        """Messages (name, second[, arrival second]) in one micro-batch, then timers."""
        rows = [("k", m[0], m[1], 1, *(a * 1_000 for a in m[2:])) for m in messages]
        out = self._rows(self.operator.handleInputRows(("k",), iter(rows), self)) if rows else []
        while due := sorted(t for t in self.timers if t <= self.watermark):
            self.timers.discard(due[0])
            out += self._rows(self.operator.handleExpiredTimer(("k",), self, None))
        return out

    def advance(self, second):
        self.watermark = max(self.watermark, second * 1_000)
        return self.batch()


def test_on_time_then_late_accumulates():
    h = Harness()
    assert h.batch(("browse", 0), ("browse", 30), ("click", 45)) == []
    assert h.advance(104) == []
    assert h.advance(105) == [("on_time", 0, 45, {"browse": 2, "click": 1})]
    assert h.batch(("click", 40)) == [("late", 0, 45, {"browse": 2, "click": 2})]


def test_message_of_a_closed_time_goes_out_at_once():
    h = Harness()
    h.advance(1_000)
    assert h.batch(("a", 10)) == [("late", 10, 0, {"a": 1})]


def test_late_message_that_reopens_a_session_waits_for_the_new_end():
    h = Harness()
    h.batch(("a", 0))
    assert h.advance(60) == [("on_time", 0, 0, {"a": 1})]
    assert h.batch(("a", 59)) == []
    assert h.advance(119) == [("on_time", 0, 59, {"a": 2})]


def test_bridge_joins_two_emitted_sessions():
    h = Harness()
    h.batch(("a", 0), ("a", 100))
    assert [r[1] for r in h.advance(500)] == [0, 100]
    assert h.batch(("b", 50)) == [("late", 0, 100, {"a": 2, "b": 1})]


def test_start_moves_back():
    h = Harness()
    h.batch(("a", 65))
    h.advance(500)
    assert h.batch(("a", 50)) == [("late", 50, 15, {"a": 2})]


def test_too_late_is_dropped_and_counted():
    h = Harness()
    h.batch(("a", 0), ("a", 45))
    h.advance(50 + GAP + LATENESS)
    assert h.batch(("b", 50)) == [("dropped", 0, 0, {"b": 1})]


def test_just_in_time_never_starts_a_partial_session():
    h = Harness()
    h.batch(("a", 0), ("a", 45))
    h.advance(45 + GAP + LATENESS)
    assert h.batch(("b", 50)) == [("late", 0, 50, {"a": 2, "b": 1})]


def test_state_is_freed():
    h = Harness()
    h.batch(("a", 0), ("a", 1_000))
    h.advance(2 * GAP + LATENESS)
    assert h.open == [1_000]
    h.advance(1_000 + 2 * GAP + LATENESS)
    assert h.empty() and not h.timers


def test_early_panes():
    h = Harness(early=True)
    assert h.batch(("a", 0)) == [("early", 0, 0, {"a": 1})]
    assert h.batch(("a", 10)) == [("early", 0, 10, {"a": 2})]
    assert h.advance(70) == [("on_time", 0, 10, {"a": 2})]


def test_final_only():
    h = Harness(final_only=True)
    assert h.batch(("a", 0), ("a", 10)) == []
    assert h.advance(10 + 2 * GAP + LATENESS - 1) == []
    assert h.advance(10 + 2 * GAP + LATENESS) == [("final", 0, 10, {"a": 2})]
    assert h.empty()


def test_watermark_jump_past_expiry_still_emits():
    h = Harness()
    h.batch(("a", 0))
    assert h.advance(10 ** 6) == [("on_time", 0, 0, {"a": 1})]
    assert h.empty()


def test_spans_that_only_meet_stay_apart():
    assert len(merge_sessions([Session(60, 60), Session(0, 0)], 60)) == 2
    assert len(merge_sessions([Session(59, 59), Session(0, 0)], 60)) == 1


def newest_cover(rows):
    """Rows left when every row loses to a later one that comes closer than the gap."""
    left = set()
    for i, (_, start, length, counts) in enumerate(rows):
        later = rows[i + 1:]
        if not any(s < start + length + GAP and start < s + n + GAP for _, s, n, _ in later):
            left.add(("k", start, length, tuple(sorted(counts.items()))))
    return left


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 2_000)), min_size=1, max_size=40),
    st.integers(0, 2 ** 32),
    st.booleans(),
)
def test_any_arrival_order_ends_in_the_true_sessions(messages, seed, early):
    rng = random.Random(seed)
    rng.shuffle(messages)
    h, out, left = Harness(early=early), [], list(messages)
    while left:
        take = rng.randint(1, len(left))
        out += h.batch(*left[:take])
        left = left[take:]
        # Never so far that a message still to come would be too late.
        limit = min([sec for _, sec in left], default=0) + GAP + LATENESS - 1
        out += h.advance(min(rng.randint(0, 2_100), limit))
    out += h.advance(10 ** 6)
    assert newest_cover(out) == brute_force([("k", name, sec) for name, sec in messages], GAP)
    assert h.empty()


@pytest.mark.parametrize("seed", range(20))
def test_final_rows_are_the_true_sessions_once(seed):
    rng = random.Random(seed)
    messages = [(rng.choice("ab"), rng.randrange(5_000)) for _ in range(60)]
    h, out = Harness(final_only=True), []
    for i in range(0, 60, 7):
        out += h.batch(*messages[i:i + 7])
        out += h.advance(rng.randrange(GAP + LATENESS - 1))
    out += h.advance(10 ** 6)
    got = [("k", s, n, tuple(sorted(c.items()))) for _, s, n, c in out]
    assert len(got) == len(set(got))
    assert set(got) == brute_force([("k", name, sec) for name, sec in messages], GAP)


def test_messages_refused_come_with_their_second_and_the_watermark():
    h = Harness()
    h.advance(50 + GAP + LATENESS)
    rows = [("k", "b", 50, 2), ("k", "c", 49, 1), ("k", "d", 51, 1)]
    out = list(h.operator.handleInputRows(("k",), iter(rows), h))
    assert [(r.pane, r.late_sec, r.watermark_ms, r.messageCount) for r in out] == [
        ("dropped", 50, h.watermark, {"b": 2}), ("dropped", 49, h.watermark, {"c": 1}), ("late", None, None, {"d": 1}),
    ]


@settings(max_examples=120, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(2, 400))
@example(356, 355)
def test_many_open_sessions_split_into_pages_and_back(seed, count):
    rng = random.Random(seed)
    h, out = Harness(lateness=10 ** 6), []
    messages = [("a", rng.randrange(count * GAP)) for _ in range(2 * count)]
    for i in range(0, len(messages), 37):
        out += h.batch(*messages[i:i + 37])
        assert (len(h.open) > LEAF) <= h.states["sessions"].value[1]
    out += h.advance(10 ** 8)
    got = {("k", s, n, tuple(sorted(c.items()))) for _, s, n, c in out}
    assert got == brute_force([("k", *m) for m in messages], GAP) and h.empty()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32))
def test_pages_that_empty_and_fill_again(seed):
    rng = random.Random(seed)
    h, out, messages, now = Harness(lateness=5_000), [], [], 0
    for _ in range(40):
        batch = [("a", now + rng.randrange(-4_000, 1_500)) for _ in range(rng.choice((0, 1, 30)))]
        batch = [m for m in batch if m[1] >= 0]
        messages += batch
        out += h.batch(*batch)
        now += rng.choice((0, 100, 3_000))
        out += h.advance(now)
        h.open
    out += h.advance(10 ** 8)
    assert newest_cover(out) == brute_force([("k", *m) for m in messages], GAP) and h.empty()


def spent(count):
    """State calls and bytes a message takes with that many open sessions, on average of many places."""
    h = Harness(lateness=10 ** 9)
    h.batch(*[("a", i * 2 * GAP) for i in range(count)])
    for state in h.states.values():
        state.calls = state.bytes = 0
    tries = 200
    for i in range(tries):
        h.batch(("b", (i * 7_919 % count) * 2 * GAP + 1))
    return [sum(getattr(s, x) for s in h.states.values()) / tries for x in ("calls", "bytes")]


def test_a_batch_reads_only_pages_near_its_messages():
    few, day, many = spent(100), spent(1_440), spent(14_400)
    # Calls stay the same; bytes grow with the list of pages only, 16 for each, read and at times written.
    assert few[0] <= day[0] + 1 and few[0] <= many[0] + 1 and max(few[0], day[0], many[0]) <= 5
    assert many[1] <= few[1] + 2 * 16 * 2 * 14_400 / LEAF


def test_a_key_with_few_sessions_is_one_value():
    h = Harness()
    h.batch(("a", 0), ("a", 1_000), ("b", 2_000))
    assert [s.calls for s in h.states.values()] == [2, 0]


def timed(**options):
    return Harness(pane_delay=60, **options)


def test_changes_within_the_delay_make_one_late_pane():
    h = timed()
    h.batch(("a", 0, 0))
    assert h.advance(100) == [("on_time", 0, 0, {"a": 1})]
    assert h.batch(("b", 10, 100)) == [] and h.batch(("c", 20, 140)) == []
    assert h.advance(159) == []
    assert h.advance(160) == [("late", 0, 20, {"a": 1, "b": 1, "c": 1})]
    assert h.batch(("d", 5, 165)) == []
    assert h.advance(225) == [("late", 0, 20, {"a": 1, "b": 1, "c": 1, "d": 1})]


def test_a_change_after_the_delay_belongs_to_the_next_pane():
    h = timed()
    h.batch(("a", 0, 0))
    h.advance(100)
    # All in one micro-batch: arrivals decide.
    assert h.batch(("b", 10, 100), ("c", 20, 159), ("d", 30, 160)) == [("late", 0, 20, {"a": 1, "b": 1, "c": 1})]
    assert h.advance(220) == [("late", 0, 30, {"a": 1, "b": 1, "c": 1, "d": 1})]


def test_early_panes_gather_and_the_on_time_pane_takes_over():
    h = timed(early=True)
    assert h.batch(("a", 0, 0)) == [] and h.batch(("a", 40, 40)) == []
    assert h.advance(60) == [("early", 0, 40, {"a": 2})]
    assert h.batch(("a", 50, 61)) == []
    assert h.advance(110) == [("on_time", 0, 50, {"a": 3})]
    assert h.advance(200) == []


def test_an_unknown_closed_session_goes_out_at_once():
    h = timed()
    h.advance(1_000)
    assert h.batch(("a", 10, 1_000)) == [("late", 10, 0, {"a": 1})]
    assert h.batch(("a", 11, 1_000)) == []
    assert h.advance(1_060) == [("late", 10, 1, {"a": 2})]


def test_a_reopened_session_waits_for_its_new_end():
    h = timed()
    h.batch(("a", 0, 0))
    assert h.advance(60) == [("on_time", 0, 0, {"a": 1})]
    assert h.batch(("b", 10, 60)) == [] and h.batch(("a", 59, 60)) == []
    assert h.advance(119) == [("on_time", 0, 59, {"a": 2, "b": 1})]
    assert h.advance(10 ** 6) == [] and h.empty()


def test_a_gathering_pane_goes_out_before_its_session_is_freed():
    h = timed()
    h.batch(("a", 0, 0))
    h.advance(GAP + LATENESS - 1)
    assert h.batch(("b", 0, GAP + LATENESS - 1)) == []
    assert h.advance(10 ** 6) == [("late", 0, 0, {"a": 1, "b": 1})] and h.empty()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 1_500), st.integers(0, 400)), min_size=1, max_size=30), st.booleans(), st.integers(0, 2 ** 32))
def test_gathered_panes_end_in_the_true_sessions(messages, early, seed):
    rng = random.Random(seed)
    rows = sorted(((name, sec, sec + delay) for name, sec, delay in messages), key=lambda r: r[2])
    h, out = timed(early=early), []
    while rows:
        take = rng.randint(1, len(rows))
        out += h.batch(*rows[:take])
        out += h.advance(rows[take - 1][2])
        rows = rows[take:]
    out += h.advance(10 ** 6)
    assert newest_cover(out) == brute_force([("k", name, sec) for name, sec, _ in messages], GAP) and h.empty()
