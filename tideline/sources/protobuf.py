"""Decoding of protobuf-encoded messages as a distributed job.

Spark's own `from_protobuf` needs the spark-protobuf module, which is not loaded here. Arrow batches
are read column by column instead (`sources.wire`); only payloads that are not plain messages go
through the protobuf runtime. Bytes that cannot be decoded become a row with an error text, so one
bad message does not fail its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tideline.model import MESSAGE
from tideline.sources.wire import read_messages

# The wire contract of a message (proto3).
MESSAGE_FIELDS = {"timestamp": 1, "session_id": 2, "message_name": 3, "message_value": 4}
TIMESTAMP_TYPE = ".google.protobuf.Timestamp"


def message_class():
    """Message type built from `MESSAGE_FIELDS`."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory, timestamp_pb2

    pool = descriptor_pool.DescriptorPool()
    pool.AddSerializedFile(timestamp_pb2.DESCRIPTOR.serialized_pb)
    file = descriptor_pb2.FileDescriptorProto(
        name="tideline_message.proto", package="tideline", syntax="proto3",
        dependency=["google/protobuf/timestamp.proto"],
    )
    message = file.message_type.add(name="Message")
    kinds = descriptor_pb2.FieldDescriptorProto
    for name, number in MESSAGE_FIELDS.items():
        field = message.field.add(name=name, number=number, label=kinds.LABEL_OPTIONAL)
        if name == "timestamp":
            field.type, field.type_name = kinds.TYPE_MESSAGE, TIMESTAMP_TYPE
        else:
            field.type = kinds.TYPE_STRING
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("tideline.Message"))


def _decode_one(kind, payload: bytes | None):
    from google.protobuf.message import DecodeError

    if payload is None:
        return None, None, None, None, "no payload"
    try:
        m = kind.FromString(payload)
    except (DecodeError, UnicodeDecodeError) as error:
        return None, None, None, None, str(error) or "undecodable payload"
    seconds = m.timestamp.seconds if m.HasField("timestamp") else None
    return m.session_id, m.message_name, m.message_value, seconds, None


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = None
    names = ["session_id", "message_name", "message_value"]
    types = [*[pa.string()] * len(names), pa.int64(), pa.string()]
    for batch in batches:
        payloads = batch.column("payload")
        if payloads.offset:
            payloads = payloads.take(pa.array(np.arange(len(payloads))))
        read = read_messages(payloads, MESSAGE_FIELDS["timestamp"], [MESSAGE_FIELDS[n] for n in names])
        columns = [*(read.strings[MESSAGE_FIELDS[n]] for n in names), read.seconds, pa.nulls(len(payloads), pa.string())]
        # What the columnar reader does not know, and what is missing, the runtime decides.
        odd = np.flatnonzero(read.odd | payloads.is_null().to_numpy(zero_copy_only=False))
        if len(odd):
            kind = kind or message_class()
            rows = [_decode_one(kind, p) for p in payloads.take(pa.array(odd)).to_pylist()]
            mask = np.zeros(len(payloads), bool)
            mask[odd] = True
            columns = [
                pc.replace_with_mask(c, pa.array(mask), pa.array(list(v), t))
                for c, v, t in zip(columns, zip(*rows), types, strict=True)
            ]
        yield pa.RecordBatch.from_arrays(
            [*columns, pc.if_else(columns[-1].is_valid(), payloads, None), batch.column("arrival")],
            names=[*names, "event_sec", "error", "payload", "arrival"],
        )


def decode_messages(payloads: DataFrame) -> DataFrame:
    """`payload BINARY, arrival TIMESTAMP` -> message columns, `error` (null when decoded) and `payload`.

    Works on batch and streaming DataFrames. A message without a timestamp decodes with a
    null `event_sec` and is rejected by the guard, not here. The payload is kept where it could
    not be decoded, so that the quarantine loses nothing.
    """
    decoded = payloads.select("payload", "arrival").mapInArrow(
        _decode_batches,
        "session_id string, message_name string, message_value string, event_sec bigint, "
        "error string, payload binary, arrival timestamp",
    )
    return decoded.select(*MESSAGE.fieldNames(), "error", "payload")


def _encode_one(kind, seconds, session_id, message_name, message_value) -> bytes:
    m = kind(
        session_id=session_id or "", message_name=message_name or "", message_value=message_value or ""
    )
    if seconds is not None:
        m.timestamp.seconds = seconds
    return m.SerializeToString()


def _encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = message_class()
    for batch in batches:
        columns = [
            batch.column(c).to_pylist()
            for c in ("event_sec", "session_id", "message_name", "message_value")
        ]
        payload = pa.array([_encode_one(kind, *row) for row in zip(*columns)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [payload, batch.column("arrival")], names=["payload", "arrival"]
        )


def encode_messages(messages: DataFrame) -> DataFrame:
    """Message columns -> `payload BINARY, arrival TIMESTAMP`, to stage encoded input."""
    return messages.select(
        "event_sec", "session_id", "message_name", "message_value", F.col("arrival")
    ).mapInArrow(_encode_batches, "payload binary, arrival timestamp")
