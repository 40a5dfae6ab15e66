import time
from datetime import datetime

import pyarrow as pa
from helpers import T0, message_frame
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tideline.model import MESSAGE
from tideline.operators.guards import quarantined
from tideline.sources.protobuf import (
    _decode_batches,
    _decode_one,
    _encode_one,
    decode_messages,
    encode_messages,
    message_class,
)


def decode(spark, *payloads):
    rows = [(bytearray(p) if p is not None else None, datetime(2024, 1, 1)) for p in payloads]
    df = spark.createDataFrame(rows, "payload binary, arrival timestamp")
    return decode_messages(df).collect()


def test_round_trip(spark):
    df = message_frame(spark, [("1", "browse", 0, 5), ("", "", -T0 - 3, 5), ("é✓", "x", None, 5)])
    back = decode_messages(encode_messages(df))
    assert back.columns == [*MESSAGE.fieldNames(), "error", "payload"]
    got = {(r.session_id, r.message_name, r.message_value, r.event_sec, r.error) for r in back.collect()}
    assert got == {("1", "browse", "", T0, None), ("", "", "", -3, None), ("é✓", "x", "", None, None)}
    assert [r.a for r in back.select(F.unix_seconds("arrival").alias("a")).distinct().collect()] == [T0 + 5]


def test_known_bytes(spark):
    # Field 1: length 2, inner field 1 varint 5; field 2: "s"; field 3: "n"; field 4: "v".
    row = decode(spark, b"\x0a\x02\x08\x05\x12\x01s\x1a\x01n\x22\x01v")[0]
    assert (row.event_sec, row.session_id, row.message_name, row.message_value) == (5, "s", "n", "v")


def test_bad_bytes_become_an_error_row(spark):
    rows = decode(spark, b"\xff\xff\xff", None, b"\x12\x02\xff\xfe", b"")
    assert [r.error is not None for r in rows] == [True, True, True, False]
    assert all(r.event_sec is None for r in rows)


def test_bad_and_timeless_messages_reach_quarantine(spark):
    df = spark.createDataFrame(
        [(bytearray(b"\xff"), datetime(2024, 1, 1)), (bytearray(b"\x12\x01s"), datetime(2024, 1, 1))],
        "payload binary, arrival timestamp",
    )
    bad = quarantined(decode_messages(df)).collect()
    assert [r.reason for r in bad] == ["undecodable", "missing_timestamp"]
    assert bad[0].error and bytes(bad[0].payload) == b"\xff" and bad[1].payload is None


def runtime(payloads):
    kind = message_class()
    return [_decode_one(kind, p) for p in payloads]


def columnar(payloads):
    batch = pa.record_batch({"payload": pa.array(payloads, pa.binary()), "arrival": pa.nulls(len(payloads), pa.int64())})
    out = next(_decode_batches(iter([batch])))
    return [tuple(r[c] for c in ("session_id", "message_name", "message_value", "event_sec", "error")) for r in out.to_pylist()]


def message(seconds, *texts):
    return _encode_one(message_class(), seconds, *texts)


TEXTS = st.text(max_size=6)
MESSAGES = st.builds(message, st.none() | st.integers(-2 ** 63, 2 ** 63 - 1), TEXTS, TEXTS, TEXTS)
# Pieces that a message can be made of, plain and odd: repeated fields, unknown ones, overlong numbers, groups, nanos.
PIECES = st.sampled_from([
    b"\x0a\x00", b"\x0a\x02\x08\x05", b"\x0a\x04\x08\x05\x10\x07", b"\x0a\x02\x10\x07", b"\x0a\x03\x08\x85\x00", b"\x12\x01s", b"\x12\x00",
    b"\x12\x81\x00s", b"\x92\x00\x01s", b"\x1a\x02\xc3\xa9", b"\x1a\x01\xff", b"\x28\x01", b"\x2d1234", b"\x2912345678", b"\x2a\x01x",
    b"\x2b\x2c", b"\x2b", b"\x10\x01", b"\x0b\x0c", b"\x00", b"\x22\x7f", b"\x0a\x0b\x08" + b"\xff" * 9 + b"\x01", b"\x0a\x0b\x08" + b"\xff" * 9 + b"\x02",
    b"\x0a\x05\x08\x01\x12\x01x", b"\x22\xff\xff\xff\xff\x0f",
])
PAYLOADS = st.none() | MESSAGES | st.binary(max_size=12) | st.lists(PIECES, max_size=5).map(b"".join) | st.tuples(MESSAGES, st.integers(0, 30)).map(lambda x: x[0][: x[1]])


@settings(max_examples=400, deadline=None)
@given(st.lists(PAYLOADS, max_size=12))
def test_columnar_reading_equals_the_runtime(payloads):
    if payloads:
        assert columnar(payloads) == runtime(payloads)


def test_many_repeated_fields_and_sliced_batches():
    payloads = [b"\x12\x01s" * n for n in (1, 31, 32, 33, 500)] + [b"\x0a" + bytes([2 * n]) + b"\x08\x05" * n for n in (1, 32, 33, 60)]
    assert columnar(payloads) == runtime(payloads)
    array = pa.array([b"\xff", *payloads, b"\x12"], pa.binary()).slice(1, len(payloads))
    batch = pa.record_batch([array, pa.nulls(len(payloads), pa.int64())], names=["payload", "arrival"])
    assert [r["session_id"] for r in next(_decode_batches(iter([batch]))).to_pylist()] == [r[0] for r in runtime(payloads)]


def test_columnar_reading_is_fast():
    payloads = [message(T0 + i, f"user{i % 100}", "browse", f'{{"page":{i}}}') for i in range(10_000)]
    batch = pa.record_batch({"payload": pa.array(payloads, pa.binary()), "arrival": pa.nulls(len(payloads), pa.int64())})

    def best(f):
        times = []
        for _ in range(5):
            start = time.process_time()
            f()
            times.append(time.process_time() - start)
        return min(times)

    def by_row():
        kind = message_class()
        rows = [_decode_one(kind, p) for p in batch.column("payload").to_pylist()]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        return [pa.array(list(v), t) for v, t in zip(zip(*rows), types, strict=True)]

    assert best(lambda: list(_decode_batches(iter([batch])))) * 5 < best(by_row)
