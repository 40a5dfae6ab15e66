"""Numpy views of Arrow text columns: bytes, words and hashes of spans.

A hash of a span comes from prefix sums of mixed bytes times powers of an odd number, modulo
2**64: the sum of a span, times the inverse power of its start, does not depend on where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The constants of the splitmix64 generator and an odd base of the powers.
GAMMA, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BASE = 0x2545F4914F6CDD1D
SLICE_BYTES = 1 << 21
# The white space of the contracts.
WHITE = " \t\n\x0b\x0c\r"


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = values.astype(np.uint64)
    x += np.uint64(GAMMA)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def unmixed(values: np.ndarray) -> np.ndarray:
    """The numbers that `mixed` took to these."""
    x = values.astype(np.uint64)
    x ^= (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x *= np.uint64(pow(MIX_2, -1, 1 << 64))
    x ^= (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x *= np.uint64(pow(MIX_1, -1, 1 << 64))
    x ^= (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return x - np.uint64(GAMMA)


def powers(count: int, base: int = BASE) -> np.ndarray:
    """base**0, base**1 and so on, modulo 2**64."""
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class SpanHash:
    """Hashes of spans of one buffer; keep one object per task, it keeps its powers."""

    def __init__(self) -> None:
        self.byte_value = mixed(np.arange(256))
        self.up = self.down = powers(0)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.up) < n:
            self.up = powers(n)
            self.down = powers(n, pow(BASE, -1, 1 << 64))
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum(self.byte_value[data] * self.up[: n - 1], out=self.prefix[1:], dtype=np.uint64)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each span; equal bytes have equal hashes wherever they are."""
        summed = (self.prefix[ends] - self.prefix[starts]) * self.down[starts]
        return mixed(summed + (ends - starts).astype(np.uint64) * np.uint64(GAMMA))


    def windows(self, size: int) -> np.ndarray:
        """The hashes of all spans of one size, by their starts."""
        summed = (self.prefix[size:] - self.prefix[:-size]) * self.down[: len(self.prefix) - size]
        return mixed(summed + np.uint64(size * GAMMA % (1 << 64)))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a text column has about `limit` bytes, or one row if that is longer."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and where each row starts and the last ends; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, values = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if large else np.int32)[column.offset: column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space, and the first word of each row (and one more)."""
    white = np.zeros(256, bool)
    white[list(WHITE.encode())] = True
    solid = ~white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) & ~edge[:-1] if len(data) else solid
    after = np.concatenate([solid[1:], [False]]) & ~edge[1:] if len(data) else solid
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive hashes, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = mixed(np.arange(width) + 1000) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k: k + n] * factors[k]
    return mixed(total)
