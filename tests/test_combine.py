import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.streaming import combine


def batches(rows, size):
    for i in range(0, len(rows), size):
        part = rows[i:i + size]
        names, seconds = [r[0] for r in part], [r[1] for r in part]
        yield pa.RecordBatch.from_pydict({
            "session_id": ["hot"] * len(part), "message_name": names,
            "event_sec": pa.array(seconds, pa.int64()), "n": pa.array([1] * len(part), pa.int64()),
        })


def total(out):
    counts = {}
    for batch in out:
        for row in batch.to_pylist():
            key = (row["message_name"], row["event_sec"])
            counts[key] = counts.get(key, 0) + row["n"]
    return counts


def test_hot_key_becomes_one_row_per_second_and_name():
    rows = [("ab"[i % 2], i % 10) for i in range(1_000)]
    out = list(combine._combine(batches(rows, 100)))
    assert sum(b.num_rows for b in out) == 10
    assert set(total(out).values()) == {100}


@pytest.mark.parametrize("limit, value", [("BUFFERED_ROWS", 50), ("BUFFERED_BYTES", 2_000)])
def test_buffer_limit_changes_no_counts(monkeypatch, limit, value):
    monkeypatch.setattr(combine, limit, value)
    for distinct in (5, 1_000):
        rows = [("a", i % distinct) for i in range(1_000)]
        counts = total(combine._combine(batches(rows, 30)))
        assert sum(counts.values()) == 1_000 and len(counts) == distinct


def test_no_input():
    assert list(combine._combine(iter(()))) == []


def test_rows_of_a_hot_key_do_not_grow_with_the_tasks(spark):
    # 64 tasks see the same ten seconds; the state operator gets each second and name once.
    hot = spark.range(0, 64_000, 1, 64).select(
        F.lit("hot").alias("session_id"), F.when(F.col("id") % 2 == 0, "a").alias("message_name"),
        (F.col("id") % 10).alias("event_sec"),
    )
    rows = combine.combine_messages(hot).collect()
    assert len(rows) == 10 and {r.n for r in rows} == {6_400}
    assert {r.message_name for r in rows} == {"a", ""}


def test_task_that_fills_its_buffer_many_times(spark):
    many = spark.range(0, 1_600_000, 1, 2).select(
        F.lit("hot").alias("session_id"), F.lit("a").alias("message_name"), (F.col("id") % 7).alias("event_sec"),
    )
    rows = combine.combine_messages(many).collect()
    assert len(rows) == 7 and sum(r.n for r in rows) == 1_600_000


def test_packed_rows_hold_what_the_rows_hold(spark, monkeypatch):
    monkeypatch.setattr(combine, "ROWS_PER_PACK", 7)
    messages = spark.range(0, 6_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k\u00e9"), F.col("id") % 200)).alias("session_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit('a"\\'), F.col("id") % 4)).alias("message_name"),
        (F.col("id") % 97 - 40).alias("event_sec"),
        F.when(F.col("id") % 11 > 0, F.timestamp_seconds(F.col("id"))).alias("clock"),
    )
    for clock in (None, "clock"):
        wanted = [tuple(r) for r in combine.combine_messages(messages, clock).collect()]
        packed = [tuple(r) for r in combine.pack_messages(messages, clock).collect()]
        assert sorted(combine.unpacked_messages(packed, bool(clock)), key=str) == sorted(wanted, key=str)
        assert max(len(p[2]) for p in packed) <= 7 * 8 * (3 if clock else 2)
    assert list(combine._packed(iter(()))) == []


def test_a_key_comes_into_the_state_operator_as_few_rows(spark):
    messages = spark.range(0, 8_000, 1, 16).select(
        (F.col("id") % 20).cast("string").alias("session_id"), F.lit("a").alias("message_name"), F.col("id").alias("event_sec"))
    packed = combine.pack_messages(messages).groupBy("session_id").count().collect()
    assert len(packed) == 20 and max(r["count"] for r in packed) <= combine.PACKERS
    assert combine.combine_messages(messages).count() == 8_000
