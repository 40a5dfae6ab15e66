"""Columnar reading of encoded messages: all payloads of an Arrow batch advance field by field together.

Rounds of numpy operations read one field of every payload at a time, so the work follows the number
of fields, not of rows. A payload that holds anything else than the known fields in their plain form
is left to the caller, who asks the protobuf runtime.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Wire types of the encoding, and the fields of a timestamp.
VARINT, LENGTH_DELIMITED = 0, 2
SECONDS, NANOS = 1, 2
# Payloads with more fields than this (repeated ones) go to the caller: each round costs as much as for all rows.
ROUNDS = 32


@dataclass
class Decoded:
    """Values per payload; `odd` marks those that were not read."""

    strings: dict[int, pa.Array]
    seconds: pa.Array
    odd: np.ndarray


class Reader:
    """Positions in the bytes of a batch; a row that runs into something unknown becomes odd."""

    def __init__(self, data: np.ndarray, end: np.ndarray) -> None:
        # No read goes further than the first byte behind a row's end.
        self.data = np.append(data, np.uint8(0))
        self.end = end
        self.odd = np.zeros(len(end), bool)

    def varint(self, rows: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value and position behind it; rows become odd whose number is cut off or over 64 bits."""
        byte, bad = self.data[at], at >= end
        value = (byte & np.uint8(127)).astype(np.uint64)
        self.odd[rows[bad]] = True
        at = at + 1
        open_ = np.flatnonzero(~bad & (byte > 127))
        for k in range(1, 10):
            if not len(open_):
                break
            byte, bad = self.data[at[open_]], at[open_] >= end[open_]
            if k == 9:
                bad |= byte > 1
            self.odd[rows[open_[bad]]] = True
            value[open_] |= (byte & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
            at[open_] += 1
            open_ = open_[~bad & (byte > 127)]
        return value, at

    def span(self, rows: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of length-delimited content."""
        size, start = self.varint(rows, at, end)
        room = np.maximum(end - start, 0).astype(np.uint64)
        self.odd[rows[size > room]] = True
        return start, start + np.minimum(size, room).astype(np.int64)


def _timestamps(reader: Reader, rows: np.ndarray, at: np.ndarray, end: np.ndarray, seconds: np.ndarray) -> None:
    """Read nested timestamps into `seconds`; a field that occurs again replaces the value before."""
    for _ in range(ROUNDS):
        left = (at < end) & ~reader.odd[rows]
        rows, at, end = rows[left], at[left], end[left]
        if not len(rows):
            return
        tag = reader.data[at]
        known = (tag == (SECONDS << 3 | VARINT)) | (tag == (NANOS << 3 | VARINT))
        reader.odd[rows[~known]] = True
        value, at = reader.varint(rows, at + 1, end)
        is_seconds = tag == (SECONDS << 3 | VARINT)
        seconds[rows[is_seconds]] = value[is_seconds].astype(np.int64)
    reader.odd[rows[at < end]] = True


def _text(reader: Reader, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The spans as strings; a row with invalid text becomes odd and empty."""
    size = np.where(reader.odd, 0, size)
    offsets = np.append(0, np.cumsum(size))
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    data = reader.data[at]
    if data.size and data.max() > 127:
        valid = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        try:
            valid.cast(pa.large_string())
        except pa.ArrowInvalid:
            row = np.repeat(np.arange(len(size)), size)
            reader.odd[np.unique(row[data > 127])] = True
            return _text(reader, start, size)
    return pa.Array.from_buffers(
        pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.string())


def read_messages(payloads: pa.Array, timestamp: int, strings: list[int]) -> Decoded:
    """Payloads -> a string column for each of the `strings` fields ('' when absent) and event seconds (null when absent)."""
    payloads = payloads.cast(pa.large_binary()).fill_null(b"")
    _, places, values = payloads.buffers()
    offsets = np.frombuffer(places, np.int64)[payloads.offset: payloads.offset + len(payloads) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    reader = Reader(data[offsets[0]: offsets[-1]], offsets[1:] - offsets[0])
    seconds, stamped = np.zeros(len(payloads), np.int64), np.zeros(len(payloads), bool)
    start = {f: np.zeros(len(payloads), np.int64) for f in strings}
    size = {f: np.zeros(len(payloads), np.int64) for f in strings}
    rows, at = np.arange(len(payloads)), offsets[:-1] - offsets[0]
    is_known = np.zeros(256, bool)
    is_known[[f << 3 | LENGTH_DELIMITED for f in (timestamp, *strings)]] = True
    for _ in range(ROUNDS):
        left = (at < reader.end[rows]) & ~reader.odd[rows]
        rows, at = rows[left], at[left]
        if not len(rows):
            break
        tag = reader.data[at]
        known = is_known[tag]
        if not known.all():
            reader.odd[rows[~known]] = True
            rows, at, tag = rows[known], at[known], tag[known]
        first, behind = reader.span(rows, at + 1, reader.end[rows])
        for field in strings:
            of = tag == (field << 3 | LENGTH_DELIMITED)
            start[field][rows[of]], size[field][rows[of]] = first[of], behind[of] - first[of]
        of = tag == (timestamp << 3 | LENGTH_DELIMITED)
        stamped[rows[of]] = True
        _timestamps(reader, rows[of], first[of], behind[of], seconds)
        at = behind
    reader.odd[rows[at < reader.end[rows]]] = True
    texts = {f: _text(reader, start[f], size[f]) for f in strings}
    return Decoded(texts, pa.array(seconds, mask=~stamped), reader.odd)
