"""Repeated strings of 200 bytes, found by suffix order within small buckets, and their removal.

Every 200-byte string chooses one of its 100-byte grams by content, that of the least hash, so equal
strings choose equal grams at equal offsets. The strings of a document that choose one gram are
consecutive and form a stretch of text, the extent. Extents meet by the hash of their gram:

- extents that are equal as a whole, by a 64-bit hash, repeat in all their strings; this settles the inside of
  shared passages with one row for about fifty bytes and without any text;
- where one gram has different extents, one of each is read again. Their bytes are put
  together and places ranked by their next 200 bytes. In the order of these ranks the nearest places that
  start earlier or later tell whether a place has a match of 200 bytes there; the match's full length is not needed;
- a gram with very many different extents is not gathered: its strings are hashed (128 bits)
  and counted by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import SpanHash, mixed, slices, text_bytes
from tideline.llm.suffixes import long_matches
from tideline.llm.tables import table, whole_text, written

LENGTH = 200
GRAM = 100
HOT_EXTENTS = 4096
SUFFIX_BYTES = 1 << 20


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = np.minimum(values[:-step], values[step:])
        span += step
    return values


def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, extent, node, place, flag for each extent of (node, text); place holds its start and length.

    Of equal extents in one slice the one with the least (node, place) is flagged 1 and speaks for the
    others, flagged 2. These are settled, so they get a key of their own and never crowd one gram.
    """
    hashes = SpanHash()
    for batch in slices(batches, "text", 1 << 20):
        data, offsets = text_bytes(batch.column("text"))
        if len(data) < LENGTH:
            continue
        hashes.load(data)
        value = hashes.windows(GRAM)
        # The least hash of each string's grams, the first place of equal ones, so content alone decides: the
        # low bits of the hash give way to the place.
        bits = np.uint64(len(data).bit_length())
        places = np.arange(len(value), dtype=np.uint64)
        least = sliding_minimum(value >> bits << bits | places, LENGTH - GRAM + 1)
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))[: len(least)]
        strings = np.flatnonzero(np.arange(len(least)) + LENGTH <= offsets[1:][row])
        if not len(strings):
            continue
        row = row[strings]
        chosen = (least[strings] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        start = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])))
        count = np.diff(np.append(start, len(strings)))
        begin, gram, row = strings[start], chosen[start], row[start]
        end = begin + count - 1 + LENGTH
        node, place = batch.column("node").to_numpy()[row], (begin - offsets[row]) << 10 | (end - begin)
        extent = mixed(hashes.spans(begin, end) + (gram - begin).astype(np.uint64))
        order = np.lexsort((place, node))
        _, first, which, count = np.unique(extent[order], return_index=True, return_inverse=True, return_counts=True)
        flag = np.zeros(len(extent), np.int64)
        flag[order] = np.where(count[which] > 1, 2, 0)
        flag[order[first[count > 1]]] = 1
        key = value[gram]
        key[flag == 2] = mixed(mixed(place[flag == 2]) + node[flag == 2].astype(np.uint64))
        yield pa.record_batch({
            "gram": key.view(np.int64), "extent": extent.view(np.int64), "node": node, "place": place, "flag": flag})


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (gram, extent, node, place): those whose gram occurs elsewhere too.

    Adds whether the extent has equals and whether the row is the first of them. Rows are compared
    with the one before and the one after, so a hot gram streams through.
    """
    names = ["gram", "extent", "node", "place", "flag"]
    before, held = None, None

    def out(rows: dict[str, np.ndarray], low: int, high: int) -> pa.RecordBatch:
        gram, extent = rows["gram"], rows["extent"]
        near = np.zeros(len(gram) + 1, bool)
        near[1:-1] = gram[1:] == gram[:-1]
        equal = near.copy()
        equal[1:-1] &= extent[1:] == extent[:-1]
        local = rows["flag"]
        shared = near[:-1] | near[1:] | (local > 0)
        copied = equal[:-1] | equal[1:] | (local > 0)
        keep = shared & (np.arange(len(gram)) >= low) & (np.arange(len(gram)) < high)
        first = ~equal[:-1] & (local < 2)
        return pa.record_batch({**{n: rows[n][keep] for n in names[:-1]}, "copied": copied[keep], "first": first[keep]})

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {n: batch.column(n).to_numpy() for n in names}
        if held is not None:
            rows = {n: np.concatenate([held[n], rows[n]]) for n in names}
        low = 0
        if before is not None:
            rows, low = {n: np.concatenate([before[n], rows[n]]) for n in names}, 1
        size = len(rows["gram"])
        yield out(rows, low, size - 1)
        held = {n: rows[n][-1:] for n in names}
        before = {n: rows[n][-2:-1] for n in names} if size - 1 > 0 else None
    if held is not None:
        low = 0
        rows = held
        if before is not None:
            rows, low = {n: np.concatenate([before[n], held[n]]) for n in names}, 1
        yield out(rows, low, len(rows["gram"]))


def cut_extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted extents of each row of (node, text, wanted)."""
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        nodes = batch.column("node").to_pylist()
        rows = []
        for k, wanted in enumerate(batch.column("wanted").to_pylist()):
            for x in wanted:
                start, size = x["place"] >> 10, x["place"] & 1023
                low = offsets[k] + start
                rows.append((x["gram"], nodes[k], x["place"], x["copied"], x["hot"], data[low: low + size].tobytes()))
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(
            zip(*rows, strict=True) if rows else [[]] * 6,
            (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()), strict=True)],
            names=["gram", "node", "place", "copied", "hot", "bytes"])


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    cut = np.append(True, places[1:] != places[:-1] + 1) if len(places) else np.zeros(0, bool)
    first = np.flatnonzero(cut)
    return places[first], places[np.append(first[1:], len(places)) - 1] if len(places) else places


def compare_extents(keep: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """node, start, end of repeated stretches, from extents sorted by (gram, node, place)."""

    def found(part: pa.Table) -> pa.RecordBatch:
        text, offsets = text_bytes(part.column("bytes").combine_chunks())
        copied = part.column("copied").to_numpy()
        starts = np.arange(len(text))
        row = np.searchsorted(offsets, starts, side="right") - 1
        hit, later = long_matches(text, LENGTH, starts + LENGTH <= offsets[row + 1])
        if keep == "none":
            hit |= later
            hit &= ~copied[row]
        places = np.flatnonzero(hit)
        # Extents lie end to end, so runs are cut where the row changes: a string never crosses a row.
        spread = places + row[places]
        first, last = runs(spread)
        at = np.searchsorted(spread, first)
        own = row[places[at]]
        shift = (part.column("place").to_numpy()[own] >> 10) - offsets[own] - own
        return pa.record_batch({
            "node": part.column("node").to_numpy()[own], "start": first + shift, "end": last + shift + LENGTH})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, size = [], 0
        for batch in batches:
            for piece in slices(iter([batch]), "bytes", SUFFIX_BYTES):
                rest.append(piece)
                size += int(text_bytes(piece.column("bytes"))[1][-1])
                if size < SUFFIX_BYTES:
                    continue
                whole = pa.Table.from_batches(rest)
                gram = whole.column("gram").to_numpy()
                cut = len(gram) - int(np.count_nonzero(gram == gram[-1]))
                if cut:
                    yield found(whole.slice(0, cut))
                rest = whole.slice(cut).combine_chunks().to_batches()
                size = sum(text_bytes(x.column("bytes"))[1][-1] for x in rest)
        if rest:
            yield found(pa.Table.from_batches(rest))

    return run


def hash_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h1, h2, node, start, copied for each string of extents of very common grams."""
    one, two = SpanHash(), SpanHash()
    two.byte_value = mixed(two.byte_value)
    for batch in slices(batches, "bytes", 1 << 17):
        data, offsets = text_bytes(batch.column("bytes"))
        starts = np.arange(max(len(data) - LENGTH + 1, 0))
        row = np.searchsorted(offsets, starts, side="right") - 1
        whole = starts + LENGTH <= offsets[row + 1]
        starts, row = starts[whole], row[whole]
        one.load(data)
        two.load(data)
        yield pa.record_batch({
            "h1": one.spans(starts, starts + LENGTH).view(np.int64), "h2": two.spans(starts, starts + LENGTH).view(np.int64),
            "node": batch.column("node").to_numpy()[row],
            "start": (batch.column("place").to_numpy()[row] >> 10) + starts - offsets[row],
            "copied": batch.column("copied").to_numpy(zero_copy_only=False)[row],
        })


def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n_bytes, spans and remaining bytes of each row of (id, text, starts, ends)."""
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        spans, kept = [], []
        for k, found in enumerate(batch.column("found").to_pylist()):
            own = data[offsets[k]: offsets[k + 1]]
            if not found:
                spans.append([])
                kept.append(own.tobytes())
                continue
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, [x["start"] for x in found], 1)
            np.add.at(edge, [x["end"] for x in found], -1)
            gone = np.cumsum(edge[:-1]) > 0
            change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans.append([{"start": int(a), "end": int(b)} for a, b in change.reshape(-1, 2)])
            kept.append(own[~gone].tobytes())
        yield pa.record_batch({
            "id": batch.column("id"), "n_bytes": np.diff(offsets),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_bytes": pa.array(kept, pa.binary()),
        })


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "none") -> DataFrame:
    """One row per input row: id, n_bytes, spans (struct start, end), kept_bytes.

    A byte goes when it is covered by a string of 200 bytes that also starts elsewhere, in another
    document or this one; overlaps count, and strings are judged on the input. `keep="none"` removes
    all copies, `keep="first"` all but the one in the row with the least row key, a hash of id and text.
    Rows that repeat an id and text are documents of their own, so they repeat each other, and share
    a row key: such rows keep nothing unless they are shorter than 200 bytes. A null text is
    empty; texts are UTF-8 bytes and may be cut within a character. An empty table gives no rows.
    """
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).withColumn(
        "node", F.xxhash64(F.col("id"), F.col("text")))
    shared = written(
        texts.select("node", "text").mapInArrow(extents, "gram long, extent long, node long, place long, flag long")
        .repartition(width, "gram").sortWithinPartitions("gram", "extent", "node", "place")
        .mapInArrow(settle, "gram long, extent long, node long, place long, copied boolean, first boolean"), "extents")

    firsts = shared.where("first")
    varied = firsts.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(
        "gram", (F.col("n") > HOT_EXTENTS).alias("hot"))
    wanted = firsts.join(varied, "gram").groupBy("node").agg(
        F.collect_list(F.struct("gram", "place", "copied", "hot")).alias("wanted"))
    cut = written(
        texts.select("node", "text").join(wanted.hint("shuffle_hash"), "node").mapInArrow(
            cut_extents, "gram long, node long, place long, copied boolean, hot boolean, bytes binary"), "extent-bytes")
    compared = cut.where("not hot").repartition(width, "gram").sortWithinPartitions("gram", "node", "place").select(
        "gram", "node", "place", "copied", "bytes").mapInArrow(compare_extents(keep), "node long, start long, end long")
    strings = cut.where("hot").select("node", "place", "copied", "bytes").mapInArrow(
        hash_strings, "h1 long, h2 long, node long, start long, copied boolean")
    repeated = strings.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min(F.struct("node", "start")).alias("least")).where("n > 1")
    hot = strings.join(repeated, ["h1", "h2"])
    hot = hot.where("not copied") if keep == "none" else hot.where(F.struct("node", "start") != F.col("least"))
    whole = shared.where("copied") if keep == "none" else shared.where("copied and not first")
    start = F.shiftright("place", 10)
    spans = (
        whole.select("node", start.alias("start"), (start + F.col("place").bitwiseAND(1023)).alias("end"))
        .unionByName(compared).unionByName(hot.select("node", "start", (F.col("start") + LENGTH).alias("end")))
    )
    by_row = spans.groupBy("node").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    return texts.join(by_row.hint("shuffle_hash"), "node", "left").select("id", "text", "found").mapInArrow(
        removed, f"id {id_type}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept_bytes binary",
    ).withColumnRenamed("id", id_column)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept_bytes")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))
