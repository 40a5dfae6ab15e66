import random

import pytest
from helpers import T0, as_set, brute_force, message_frame
from pyspark.sql import functions as F

from tideline.operators.sessions import fragments, session_message_counts, session_metrics, sessions_per_minute
from tideline.sources.messages import normalise


def run(spark, rows, gap=60):
    return as_set(session_metrics(message_frame(spark, [(*r, 0) for r in rows]), gap))


def test_gap_is_strict(spark):
    for delta, expected in ((59, 1), (60, 2), (61, 2)):
        assert len(run(spark, [("k", "a", 0), ("k", "b", delta)])) == expected


def test_metrics_of_one_session(spark):
    rows = [("1", "browse", 0), ("1", "browse", 30), ("1", "click", 45)]
    assert run(spark, rows) == {("1", 0, 45, (("browse", 2), ("click", 1)))}


def test_single_message_has_length_zero(spark):
    assert run(spark, [("1", "a", 7)]) == {("1", 7, 0, (("a", 1),))}


def test_missing_strings_are_empty_strings(spark):
    assert run(spark, [(None, None, 0), ("", "", 1)]) == {("", 0, 1, (("", 2),))}


def test_message_without_time_is_left_out(spark):
    assert run(spark, [("1", "a", 0), ("1", "a", None)]) == {("1", 0, 0, (("a", 1),))}


def test_times_before_1970(spark):
    rows = [("k", "a", -T0 - 61), ("k", "b", -T0 - 2), ("k", "c", -T0 + 57), ("k", "d", -T0 + 117)]
    assert run(spark, rows) == brute_force(rows, 60)


def test_seconds_are_cut_before_sessions_are_formed(spark):
    df = spark.sql("""select 'k' as id, 'a' as name, timestamp'2024-01-01 00:00:00.9' as ts
                      union all select 'k', 'a', timestamp'2024-01-01 00:01:00.1'""")
    for kind in ("timestamp", "timestamp_ntz"):
        rows = normalise(df.withColumn("ts", F.col("ts").cast(kind)), "id", "name", "ts")
        assert session_metrics(rows).count() == 2


@pytest.mark.parametrize("gap", [1, 60, 500])
def test_equals_brute_force(spark, gap):
    rng = random.Random(gap)
    rows = [(rng.choice("abc"), rng.choice("xyz"), rng.randrange(-3_000, 9_000)) for _ in range(400)]
    assert run(spark, rows, gap) == brute_force(rows, gap)


def test_equals_native_session_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice("xyz"), rng.randrange(20_000), 0) for _ in range(400)]
    df = message_frame(spark, rows)
    native = (
        df.withColumn("ts", F.timestamp_seconds("event_sec"))
        .groupBy("session_id", F.session_window("ts", "59 seconds 999999 microseconds"))
        .agg(F.min("event_sec").alias("start"), F.max("event_sec").alias("last"), F.collect_list("message_name").alias("names"))
    )
    expected = {
        (r.session_id, r.start - T0, r.last - r.start, tuple(sorted((n, r.names.count(n)) for n in set(r.names))))
        for r in native.collect()
    }
    assert as_set(session_metrics(df)) == expected


def test_hot_key_is_reduced_before_the_window(spark):
    # A million messages of one key become one row per slot and name.
    hot = spark.range(1_000_000).select(
        F.lit("hot").alias("session_id"), F.lit("n").alias("message_name"),
        (F.col("id") % 3_600).alias("event_sec"),
    )
    assert fragments(hot).count() == 60
    row = session_metrics(hot).first()
    assert (row.sessionLengthSeconds, row.messageCount) == (3_599, {"n": 1_000_000})


def test_plan_reduces_before_both_shuffles(spark):
    df = message_frame(spark, [("k", "a", 0, 0)])
    plan = session_message_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count" in plan


def test_fixed_minutes(spark):
    rows = [("a", "x", 59), ("b", "x", 0), ("b", "x", 30), ("c", "x", 60)]
    sessions = session_metrics(message_frame(spark, [(*r, 0) for r in rows]))
    got = {(r.minute_second - T0, r.sessions, r.total_seconds) for r in sessions_per_minute(sessions).collect()}
    assert got == {(0, 2, 30), (60, 1, 0)}
