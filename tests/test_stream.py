"""Streams in staged micro-batches: the job is run to the end of its input after each step."""

from __future__ import annotations

import random
import time

import pytest
from helpers import T0, as_set, brute_force, message_frame
from pyspark.sql import Row, functions as F

from tideline.model import LATE_MESSAGE, REVISION, SESSION, clean_schema, raw_schema
from tideline.operators.dedupe import latest_revision
from tideline.operators.observe import (
    MESSAGES,
    REVISIONS,
    MetricsTable,
    observed,
    read_metrics,
    record_metrics,
)
from tideline.operators.reconcile import reconcile
from tideline.plans import pipeline, replay
from tideline.plans.notice_job import run_dedupe_on_notice
from tideline.plans.pipeline import UNTIL_DONE, run_pipeline, run_quarantine
from tideline.plans.replay import replay_final, replay_rows
from tideline.sources.messages import read_messages, stream_messages
from tideline.sources.notices import read_notices
from tideline.sources.partitions import scan_table
from tideline.streaming.minutes import minute_totals
from tideline.streaming.native import native_final_sessions
from tideline.streaming.processor import PACKED, PackedRevisions, unpacked
from tideline.streaming.revisions import final_sessions

DAY = 86_400


class Job:
    """The session job over a landing folder, restarted from its checkpoint at every step."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.landing, self.raw = f"{folder}/landing", f"{folder}/raw"
        self.notices, self.clean = f"{folder}/notices", f"{folder}/clean"
        self.seen = set()

    def start(self):
        return run_pipeline(
            stream_messages(self.spark, self.landing), self.raw, self.notices,
            f"{self.folder}/checkpoint", UNTIL_DONE, **self.options,
        )

    def land(self, rows):
        message_frame(self.spark, rows).coalesce(1).write.mode("append").parquet(self.landing)

    def step(self, *rows):
        """Land messages, run, and return the new revisions (pane, session, start, length, counts)."""
        self.land(rows)
        self.query = self.start()
        self.query.awaitTermination()
        try:
            now = scan_table(self.spark, self.raw, raw_schema()).collect()
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            now = []
        rows = {
            (r.pane, r.sessionId, r.session_start - T0, r.sessionLengthSeconds,
             tuple(sorted(r.messageCount.items())), r.rt) for r in now
        }
        new, self.seen = rows - self.seen, rows
        return sorted(r[:-1] for r in new)

    def dedupe(self):
        run_dedupe_on_notice(
            self.spark, self.notices, self.raw, self.clean, f"{self.folder}/dedupe", UNTIL_DONE
        ).awaitTermination()
        return scan_table(self.spark, self.clean, clean_schema())


def tick(second):
    """A message of another key that moves the arrival clock."""
    return ("~", "tick", second, second)


ON_TIME = [("1", "browse", 0, 60), ("1", "browse", 30, 60), ("1", "click", 45, 60)]


def test_on_time_and_late_panes(spark, folder):
    job = Job(spark, folder)
    assert job.step(*ON_TIME) == []
    assert job.step(tick(105)) == [("on_time", "1", 0, 45, (("browse", 2), ("click", 1)))]
    assert job.step(("1", "click", 40, 105)) == [("late", "1", 0, 45, (("browse", 2), ("click", 2)))]
    # The same through notices and the deduplication they trigger.
    notices = [r.event_time_second - T0 for r in read_notices(spark, job.notices).collect()]
    assert notices == [0, 0]
    clean = job.dedupe()
    assert as_set(clean) == {("1", 0, 45, (("browse", 2), ("click", 2)))}
    assert "rt" in clean.columns


def test_all_messages_an_hour_old_on_arrival(spark, folder):
    job = Job(spark, folder)
    old = 3_600
    assert job.step(*[("2", n, t, t + old) for n, t in (("browse", 0), ("browse", 30), ("click", 45))]) \
        == [("on_time", "2", 0, 45, (("browse", 2), ("click", 1)))]
    assert job.step(("2", "click", 40, 115 + old)) == [("late", "2", 0, 45, (("browse", 2), ("click", 2)))]


def test_notice_names_the_event_minute(spark, folder):
    job = Job(spark, folder)
    job.step(*[("1", n, 17 + t, 17 + t) for n, t in (("browse", 0), ("browse", 30), ("click", 45))], tick(200))
    text = [r.value for r in spark.read.option("recursiveFileLookup", "true").text(job.notices).collect()]
    assert text == ['{"event_time_second":%d}' % T0]


def test_merges_across_minutes_need_reconciling(spark, folder):
    job = Job(spark, folder)
    job.step(("7", "a", 0, 0), ("7", "a", 100, 100), ("9", "a", 65, 65), tick(500))
    assert job.step(("7", "b", 50, 500), ("9", "b", 50, 500)) == [
        ("late", "7", 0, 100, (("a", 2), ("b", 1))), ("late", "9", 50, 15, (("a", 1), ("b", 1))),
    ]
    clean = job.dedupe()
    stale = {("7", 100, 0, (("a", 1),)), ("9", 65, 0, (("a", 1),))}
    true = {("7", 0, 100, (("a", 2), ("b", 1))), ("9", 50, 15, (("a", 1), ("b", 1)))}
    assert as_set(clean) == stale | true
    assert as_set(reconcile(clean)) == true


def test_lateness_boundary(spark, folder):
    job = Job(spark, folder)
    job.step(*ON_TIME, tick(105))
    job.step(tick(105 + DAY))
    # Arrives out of order, behind the clock, but within lateness: the whole session again.
    assert job.step(("1", "late", 50, 50 + DAY)) == [("late", "1", 0, 50, (("browse", 2), ("click", 1), ("late", 1)))]
    job.step(tick(110 + DAY))
    assert job.step(("1", "late", 50, 50 + DAY)) == []
    assert sum(m["dropped_messages"] or 0 for m in observed(job.query, REVISIONS)) == 1


def test_bad_messages_are_quarantined(spark, folder):
    job = Job(spark, folder)
    rows = [("1", "a", 0, 0), ("1", "no time", None, 5), ("1", "old", 10, 11 + DAY), ("1", "edge", 20, 20 + DAY)]
    assert job.step(*rows) == [("on_time", "1", 0, 20, (("a", 1), ("edge", 1)))]
    seen = observed(job.query, MESSAGES)[0]
    assert (seen["rows"], seen["rejected"]) == (4, 2)
    run_quarantine(
        stream_messages(spark, job.landing), f"{folder}/bad", f"{folder}/bad-checkpoint", UNTIL_DONE
    ).awaitTermination()
    bad = spark.read.parquet(f"{folder}/bad").collect()
    assert sorted((r.message_name, r.reason) for r in bad) == [("no time", "missing_timestamp"), ("old", "skew")]
    assert read_messages(spark, job.landing).count() == 4


@pytest.mark.parametrize("clock", ["arrival", "event"])
def test_rejected_messages_do_not_move_the_clock(spark, folder, clock):
    job = Job(spark, folder, clock=clock)
    far = 3_650 * DAY
    job.step(("1", "a", 0, 0), ("1", "ahead", far, 5), ("1", "arrival ahead", 10, far), ("1", "both ahead", far, far))
    assert observed(job.query, MESSAGES)[0]["rejected"] == 3
    found = job.step(("2", "b", 30, 40)) + job.step(("3", "c", 5_000, 5_000))
    assert sum(m["dropped_messages"] or 0 for m in observed(job.query, REVISIONS)) == 0
    assert {r[1:3] for r in job.seen} >= {("1", 0), ("2", 30)} and found


def test_failed_batch_is_replayed_without_doubling(spark, folder, monkeypatch):
    job = Job(spark, folder)
    real, calls = pipeline.write_notices, []

    def fail_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost after the data was written")
        return real(*args)

    monkeypatch.setattr(pipeline, "write_notices", fail_once)
    job.land([*ON_TIME, tick(500)])
    query = job.start()
    with pytest.raises(Exception, match="lost after the data"):
        query.awaitTermination()
    written = scan_table(spark, job.raw, raw_schema()).collect()
    job.start().awaitTermination()
    again = scan_table(spark, job.raw, raw_schema()).collect()
    assert len(calls) == 2 and len(written) == 1
    assert [(r.sessionId, r.rt) for r in again] == [(r.sessionId, r.rt) for r in written]
    assert read_notices(spark, job.notices).count() == 1


def test_revisions_of_a_key_leave_the_state_as_one_text(spark):
    names = ["", "a", 'quote " and \\ \n', "\u00e9\U0001f600", "n" * 60_000]
    rows = [
        Row(sessionId="k", sessionLengthSeconds=i, messageCount={n: 2**40 + i for n in names[:i % 6]}, session_start=T0 + i,
            pane="late", late_sec=None if i % 2 else 2**40, watermark_ms=None if i % 3 else 2**41) for i in range(1_500)
    ]
    operator = PackedRevisions(60, 0)
    packed = list(operator._packed(("k",), iter(rows)))
    assert len(packed) == 2 and list(operator._packed(("k",), iter(()))) == []
    found = unpacked(spark.createDataFrame(packed, PACKED))
    assert found.schema.names == REVISION.fieldNames()
    assert sorted(found.collect(), key=lambda r: r.session_start) == rows


def test_state_partitions_of_a_replay_follow_the_messages(spark, monkeypatch):
    assert replay._streaming_conf(spark, spark.range(500))["spark.sql.shuffle.partitions"] == "4"
    monkeypatch.setattr(replay, "MESSAGES_PER_STATE", 50)
    assert replay._streaming_conf(spark, spark.range(401))["spark.sql.shuffle.partitions"] == "12"


def test_early_panes(spark, folder):
    job = Job(spark, folder, early=True)
    assert [r[0] for r in job.step(*ON_TIME)] == ["early"]
    assert job.step(("1", "click", 50, 61))[0] == ("early", "1", 0, 50, (("browse", 2), ("click", 2)))
    assert ("on_time", "1", 0, 50, (("browse", 2), ("click", 2))) in job.step(tick(110))


@pytest.mark.parametrize("clock", ["arrival", "event"])
def test_random_waves_end_in_the_true_sessions(spark, folder, clock):
    rng = random.Random(11)
    rows = []
    for _ in range(300):
        second = rng.randrange(8_000)
        rows.append((rng.choice("abcde"), rng.choice("xy"), second, second + rng.choice((0, 5, 300, 5_000))))
    rows.sort(key=lambda r: r[3])
    job = Job(spark, folder, clock=clock)
    for i in range(0, 300, 75):
        job.step(*rows[i:i + 75])
    job.step(tick(80_000))
    sessions = reconcile(job.dedupe())
    expected = brute_force([r[:3] for r in rows], 60)
    assert {r for r in as_set(sessions) if r[0] != "~"} == expected
    # Deduplication of the whole raw dataset at once agrees.
    raw = scan_table(spark, job.raw, raw_schema()).withColumn("minute", F.expr("session_start div 60"))
    whole = reconcile(latest_revision(raw).drop("pane"))
    assert as_set(whole) == as_set(sessions)


def test_small_arrow_batches_give_the_same_rows(spark, folder):
    rows = [("1", rng, t, t) for t, rng in enumerate("abcab" * 8)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = Job(spark, folder).step(*rows, tick(500))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [("on_time", "1", 0, 39, (("a", 16), ("b", 16), ("c", 8)))]


def test_final_sessions_come_once(spark):
    waves = [
        [("1", "a", 0, 0), ("1", "a", 30, 30), ("2", "b", 500, 500)],
        [("1", "c", 45, 600)],
        [tick(DAY)],
    ]
    frames = [message_frame(spark, rows).withColumn("wave", F.lit(i)) for i, rows in enumerate(waves, 1)]
    out = replay_final(spark, frames[0].union(frames[1]).union(frames[2]), 3, lateness=3_600)
    assert out.columns == SESSION.fieldNames()
    assert as_set(out) == {("1", 0, 45, (("a", 2), ("c", 1))), ("2", 500, 0, (("b", 1),))}


def test_json_messages_without_arrival(spark, folder):
    path = f"{folder}/in"
    message_frame(spark, ON_TIME).drop("arrival").write.json(path)
    query = run_pipeline(
        stream_messages(spark, path, "json", 1_000_000), f"{folder}/raw", None, f"{folder}/checkpoint",
        UNTIL_DONE, max_skew=100 * 365 * DAY,
    )
    query.awaitTermination()
    # The files are written now, long after the events, so the session is closed.
    assert as_set(scan_table(spark, f"{folder}/raw", raw_schema())) == {("1", 0, 45, (("browse", 2), ("click", 1)))}


def test_late_messages_go_to_a_table_of_their_own(spark, folder):
    late = f"{folder}/late"
    job = Job(spark, folder, late_root=late, lateness=3_600)
    job.step(*ON_TIME, tick(105))
    job.step(tick(50 + 60 + 3_600))
    # Two of one second, one of another; the third is just in time.
    rows = [("1", n, t, 9_000) for n, t in (("x", 50), ("x", 50), ("y", 49), ("z", 51))]
    assert [r[0] for r in job.step(*rows) if r[1] == "1"] == ["late"]
    rows = spark.read.schema(LATE_MESSAGE).parquet(late).collect()
    watermark = (T0 + 50 + 60 + 3_600) * 1_000
    assert sorted((r.session_id, r.message_name, r.n, r.event_sec - T0, r.watermark_ms) for r in rows) == [
        ("1", "x", 2, 50, watermark), ("1", "y", 1, 49, watermark),
    ]


def test_panes_gather_changes_across_restarts(spark, folder):
    job = Job(spark, folder, pane_delay=60)
    assert [r[0] for r in job.step(*ON_TIME, tick(105))] == ["on_time"]
    assert job.step(("1", "a", 40, 105)) == [] and job.step(("1", "b", 41, 164)) == []
    counts = (("a", 1), ("b", 1), ("browse", 2), ("click", 1))
    assert ("late", "1", 0, 45, counts) in job.step(tick(165))
    assert not [r for r in job.step(("1", "c", 42, 170)) if r[1] == "1"]
    assert [r for r in job.step(tick(300)) if r[1] == "1"] == [("late", "1", 0, 45, (("a", 1), ("b", 1), ("browse", 2), ("c", 1), ("click", 1)))]


def test_many_open_sessions_of_a_key(spark, folder):
    job = Job(spark, folder, grain="day")
    seconds = list(range(0, 40_000, 200))
    job.land([("1", "a", t, t) for t in seconds])
    job.start().awaitTermination()
    job.land([("1", "b", t + 30, 40_000) for t in seconds[::3]])
    job.start().awaitTermination()
    raw = scan_table(spark, job.raw, raw_schema("day")).withColumn("minute", F.expr("session_start div 60"))
    got = as_set(latest_revision(raw))
    expected = brute_force([("1", "a", t) for t in seconds] + [("1", "b", t + 30) for t in seconds[::3]], 60)
    assert got == expected


def test_metrics_are_kept_by_batch(spark, folder):
    root = f"{folder}/metrics"
    job = Job(spark, folder)
    listener = MetricsTable(spark, f"{folder}/heard")
    spark.streams.addListener(listener)
    job.step(*ON_TIME, tick(105), ("1", "no time", None, 60))
    record_metrics(job.query, root)
    # The same again, as after a restart, changes nothing.
    record_metrics(job.query, root)
    job.step(tick(5_000), ("1", "late", 10, 5_000))
    record_metrics(job.query, root)
    rows = read_metrics(spark, root)
    assert rows.select("query").distinct().collect() == [("session-revisions",)]
    assert rows.groupBy("batch_id", "observed", "metric").count().where("count > 1").count() == 0
    totals = {(r.observed, r.metric): r.total for r in rows.groupBy("observed", "metric").agg(F.sum("value").alias("total")).collect()}
    assert totals["messages", "rows"] == 7 and totals["messages", "rejected"] == 1
    assert totals["revisions", "on_time"] == 2 and totals["revisions", "late"] == 1
    # The listener hears of the batches a moment later, one after the other.
    for _ in range(100):
        heard = read_metrics(spark, f"{folder}/heard")
        if heard.count() == rows.count():
            break
        time.sleep(0.2)
        spark.catalog.refreshByPath(f"{folder}/heard")
    spark.streams.removeListener(listener)
    assert sorted(heard.collect(), key=str) == sorted(rows.collect(), key=str)


def minutes_of(rows):
    totals = {}
    for _, start, length, _ in rows:
        n, seconds = totals.get(start // 60 * 60, (0, 0))
        totals[start // 60 * 60] = (n + 1, seconds + length)
    return totals


def random_waves(spark, seed):
    """Messages in four waves by arrival, the last far behind the others, and the true sessions."""
    rng = random.Random(seed)
    rows = [(rng.choice("abcde"), rng.choice("xy"), second, second + rng.choice((0, 5, 300))) for second in rng.sample(range(6_000), 250)]
    rows.sort(key=lambda r: r[3])
    frames = [
        message_frame(spark, part).withColumn("wave", F.lit(i))
        for i, part in enumerate((rows[:80], rows[80:160], rows[160:], [tick(3 * DAY)]), 1)
    ]
    messages = frames[0]
    for frame in frames[1:]:
        messages = messages.unionByName(frame)
    return messages, brute_force([r[:3] for r in rows], 60)


def test_minutes_of_the_stream_equal_the_batch(spark):
    messages, sessions = random_waves(spark, 3)
    restated = replay_rows(
        spark, messages, 4, lambda m: minute_totals(final_sessions(m, lateness=3_600, output_mode="Append")), "append")
    last = {}
    for row in restated.orderBy("batch_id").collect():
        last[row.minute_second - T0] = (row.sessions, row.total_seconds)
    assert last == minutes_of(sessions)


def test_native_windows_give_the_final_sessions(spark):
    messages, sessions = random_waves(spark, 5)
    rows = replay_rows(spark, messages, 4, lambda m: native_final_sessions(m, lateness=3_600), "append")
    assert rows.columns == [*SESSION.fieldNames(), "batch_id"] and as_set(rows) == sessions


def test_native_windows_run_without_python(spark, folder):
    message_frame(spark, ON_TIME).write.parquet(f"{folder}/in")
    plan = native_final_sessions(stream_messages(spark, f"{folder}/in"))._jdf.queryExecution().analyzed().toString()
    assert "SessionWindow" in plan or "session_window" in plan
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
