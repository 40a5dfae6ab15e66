"""Alignment of two tokenizers: token byte ranges coalesced into groups, links counted over the corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tideline.llm.buffers import slices
from tideline.llm.chunks import SPACE, Numbered, cut, ids_of, json_cuts_at_spaces, json_tokenizer, pieces_cut_at_spaces
from tideline.llm.tables import table, whole_text, written

BLOCK_BYTES = 2 << 20
SHIFT = 32
# A block's row has megabytes, so a page ends after each: buffers outside the heap are as large as a page, which else has 100 rows.
PAGE_A_ROW = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
GROUPS = "start long, end long, a array<int>, b array<int>"


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """The bytes of all ids end to end, with starts and lengths."""

    def __init__(self, entries: list[bytes]) -> None:
        self.size = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        # Decimal digits of each id and room for a separator.
        digits = [str(i).encode() for i in range(len(entries))]
        width = max(map(len, digits), default=0) + 1
        self.digit_count = np.fromiter(map(len, digits), np.int64, len(digits))
        self.digits = np.frombuffer(b"".join(d.ljust(width) for d in digits), np.uint8).reshape(-1, width)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.repeat(self.start[ids] - ends + size, size) + np.arange(int(size.sum()))]


def coalesce(end_a: np.ndarray, end_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, from the ends and sizes of their byte ranges.

    All tokens are sorted by start; a group breaks where a start reaches the greatest end so far.
    """
    start = np.concatenate([end_a - size_a, end_b - size_b])
    order = np.lexsort((start,))
    reach = np.maximum.accumulate(np.concatenate([end_a, end_b])[order])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(np.append(False, start[order][1:] >= reach[:-1])) if len(start) else start
    return group[: len(end_a)], group[len(end_a):]


def overlaps(end_a: np.ndarray, end_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all A-B pairs whose byte ranges overlap, A in order, B in order below it."""
    first = np.searchsorted(end_b, end_a - size_a, side="right")
    count = np.searchsorted(end_b - size_b, end_a, side="left") - first
    a = np.repeat(np.arange(len(end_a)), count)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + first[a]


class Aligner:
    """Tokens, groups and links of distinct chunks; a chunk whose tokens do not spell its bytes has none."""

    def __init__(self, json_file: bytes, model: bytes) -> None:
        import sentencepiece

        self.a = json_tokenizer(json_file, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        of = byte_level()
        ids = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        of_a = [ids.get(i, "") for i in range(max(ids, default=-1) + 1)]
        self.of_a = Vocabulary([bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t in of_a])
        self.of_b = Vocabulary([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
            else p.replace(SPACE, " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ])
        self.in_chunks = json_cuts_at_spaces(json_file) and pieces_cut_at_spaces(self.b)
        self.before = len(self.b.encode("a"))

    def cut(self, text: str) -> list[str]:
        """Chunks of the text with a space in front, which begin with a space each; empty text: none."""
        if not text:
            return []
        return cut(" " + text) if self.in_chunks else [" " + text]

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of A, their counts, ids of B, their counts, and which chunks both spell out; the others have no ids."""
        a = list(ids_of(self.a, chunks))
        # B puts the first space in front itself, except before nothing.
        b = self.b.encode([c[1:] for c in chunks], num_threads=1)
        for at in [k for k, c in enumerate(chunks) if c == " "]:
            b[at] = self.b.encode("a ")[self.before:]
        size = np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks))
        good = np.ones(len(chunks), bool)
        flat, counts = [], []
        for ids, vocabulary in ((a, self.of_a), (b, self.of_b)):
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            tokens = np.fromiter((i for x in ids for i in x), np.int64, int(count.sum()))
            total = np.bincount(np.repeat(np.arange(len(ids)), count), vocabulary.size[tokens], len(ids)).astype(np.int64)
            good &= total == size
            flat.append(tokens)
            counts.append(count)
        text = np.frombuffer("".join(c for c, g in zip(chunks, good.tolist(), strict=True) if g).encode(), np.uint8)
        chunk_of_byte = np.repeat(np.flatnonzero(good), size[good])
        right = good.copy()
        for tokens, count, vocabulary in ((flat[0], counts[0], self.of_a), (flat[1], counts[1], self.of_b)):
            spelled = vocabulary.joined(tokens[np.repeat(good, count)])
            right[chunk_of_byte[spelled != text]] = False
        for k in (0, 1):
            flat[k] = flat[k][np.repeat(right, counts[k])]
            counts[k] = np.where(right, counts[k], 0)
        return flat[0], counts[0], flat[1], counts[1], right

    def align(self, chunks: list[str]) -> dict[str, np.ndarray]:
        """Per chunk: good, tokens of A and B, groups, links, text of groups; per link, in chunk order: its pair of ids."""
        a, count_a, b, count_b, good = self.encode(chunks)
        size_a, size_b = self.of_a.size[a], self.of_b.size[b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        chunk_a, chunk_b = (np.repeat(np.arange(len(chunks)), c) for c in (count_a, count_b))
        group_a, group_b = coalesce(end_a, end_b, size_a, size_b)
        left, right = overlaps(end_a, end_b, size_a, size_b)
        together = end_a[left] == end_b[right]
        left, right = left[together], right[together]
        first = np.flatnonzero(np.append(True, group_a[1:] != group_a[:-1])) if len(a) else np.zeros(0, np.int64)
        return {
            "good": good, "n_a": count_a, "n_b": count_b,
            "groups": np.bincount(chunk_a[first], minlength=len(chunks)),
            "links": np.bincount(chunk_a[left], minlength=len(chunks)),
            "pairs": a[left] << SHIFT | b[right],
            "text": self.group_text(a, b, group_a, group_b, chunk_a, chunk_b, len(chunks)),
        }

    def group_text(self, a, b, group_a, group_b, chunk_a, chunk_b, n: int) -> np.ndarray:
        """`a1,a2|b1;` for each group, end to end for each chunk."""
        group, chunk = np.concatenate([group_a, group_b]), np.concatenate([chunk_a, chunk_b])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))
        group, chunk, side = group[order], chunk[order], side[order]
        width = max(self.of_a.digits.shape[1], self.of_b.digits.shape[1])
        cells = np.zeros((len(group), width), np.uint8)
        cells[: len(a), : self.of_a.digits.shape[1]] = self.of_a.digits[a]
        cells[len(a):, : self.of_b.digits.shape[1]] = self.of_b.digits[b]
        digits = np.concatenate([self.of_a.digit_count[a], self.of_b.digit_count[b]])[order]
        cells = cells[order]
        new_group = np.append(group[1:] != group[:-1], True)[: len(group)]
        new_side = np.append(side[1:] != side[:-1], True)[: len(group)]
        cells[np.arange(len(group)), digits] = np.where(new_group, ord(";"), np.where(new_side, ord("|"), ord(",")))
        flat = cells[np.arange(width) <= digits[:, None]].tobytes()
        ends = np.cumsum(np.bincount(chunk, digits + 1, n)).astype(np.int64).tolist()
        return np.array([flat[s:e] for s, e in zip([0, *ends], ends, strict=False)], object)


def aligned_blocks(json_file: bytes, model: bytes, id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each block of about 2 MB of text: per text its figures and chunks, per chunk its links, the block's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, numbered = Aligner(json_file, model), Numbered()
        task, seq = TaskContext.get().partitionId(), 0
        known: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", BLOCK_BYTES):
            cut_texts = list(map(aligner.cut, pc.fill_null(batch.column("text"), "").to_pylist()))
            if numbered.full():
                numbered.clear()
                known = {}
            fresh = aligner.align(numbered.add(cut_texts))
            known = {k: np.concatenate([known[k], v]) if known else v for k, v in fresh.items()}
            sizes = np.fromiter(map(len, cut_texts), np.int64, len(cut_texts))
            chunk = np.fromiter((numbered.number[c] for x in cut_texts for c in x), np.int64, int(sizes.sum()))
            text_of = np.repeat(np.arange(len(sizes)), sizes)
            spelled = np.ones(len(sizes), bool)
            spelled[text_of[~known["good"][chunk]]] = False
            chunk, sizes = chunk[spelled[text_of]], np.where(spelled, sizes, 0)
            ends = np.append(0, np.cumsum(sizes))
            distinct, local = np.unique(chunk, return_inverse=True)
            links = known["links"][distinct]
            first = (np.cumsum(known["links"]) - known["links"])[distinct]
            at = np.repeat(first - np.cumsum(links) + links, links) + np.arange(int(links.sum()))
            pairs, pair_of = np.unique(known["pairs"][at], return_inverse=True)
            times = np.repeat(np.bincount(local, minlength=len(distinct)), links)
            texts = known["text"]

            def totals(of: str) -> pa.Array:
                running = np.append(0, np.cumsum(known[of][chunk]))
                return pa.array(running[ends[1:]] - running[ends[:-1]])

            shas = []
            for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                whole = b"".join(texts[chunk[s:e]])[:-1]
                shas.append(hashlib.sha256(whole).hexdigest() if e > s else "")
            lists = {
                "ids": batch.column("id").cast(id_type), "n_a": totals("n_a"), "n_b": totals("n_b"), "n_groups": totals("groups"),
                "n_links": totals("links"), "sizes": pa.array(sizes), "pairs": pa.array(pairs),
                "pair_n": pa.array(np.bincount(pair_of, times, len(pairs)).astype(np.int64)), "shas": pa.array(shas, pa.string()),
            }
            yield pa.record_batch({
                "block": pa.array([task << 33 | seq], pa.int64()),
                **{k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in lists.items()},
                "chunk_of": pa.array([local.astype(np.int32).tobytes()], pa.binary()),
                "links": pa.array([links.astype(np.int32).tobytes()], pa.binary()),
                "pair_of": pa.array([pair_of.astype(np.int32).tobytes()], pa.binary()),
            })
            seq += 1

    return run


def sums_of(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the values, in whole numbers."""
    running = np.append(0, np.cumsum(values))
    ends = np.cumsum(sizes)
    return running[ends] - running[ends - sizes]


def count_links(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Per text of a block, the sums of its links' counts and of the links that are their B id's best."""
    row = block.to_pylist()[0]
    order = np.argsort(counts.column("pair").to_numpy())
    count, best = counts.column("n").to_numpy()[order], counts.column("best").to_numpy()[order].astype(np.int64)
    links, pair_of, chunk_of = (np.frombuffer(row[k], np.int32).astype(np.int64) for k in ("links", "pair_of", "chunk_of"))
    sizes = np.array(row["sizes"], np.int64)
    return pa.table({
        "id": block.column("ids").combine_chunks().flatten(), **{k: pa.array(row[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")},
        "n_best": sums_of(sums_of(best[pair_of], links)[chunk_of], sizes),
        "count_sum": sums_of(sums_of(count[pair_of], links)[chunk_of], sizes),
        "groups_sha256": pa.array(row["shas"], pa.string()),
    })


def link_counts(pairs: DataFrame) -> DataFrame:
    """Pairs of ids (A above, B below 32 bits) with partial counts -> pair, n, best: greatest of its B id, ties too.

    An A vocabulary bounds the pairs of a B id, so a common B id is no large group.
    """
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)))
    counts = pairs.groupBy("pair").agg(F.sum("pair_n").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_b))


def align_texts(docs: DataFrame, json_path: str, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a tokenizer file of the `tokenizers` library on space + text, B a sentencepiece model on the
    text. Texts are encoded, aligned and counted by blocks; the corpus counts come from all blocks'
    distinct pairs, summed before and after one shuffle, and go back to each block through a join. So a
    common pair costs a row for each block, not for each of its occurrences, and nothing is broadcast.

    A null or empty text, and one whose tokens do not spell out space + text, has zeros and ''. Repeated
    rows and rows without an id each keep their row (and count as often as they occur); other columns are
    ignored; an empty table gives none. A very long text is one block.
    """
    files = []
    for path in (json_path, model_path):
        with open(path, "rb") as file:
            files.append(file.read())
    kind = docs.schema[id_column].dataType.simpleString()
    numbers = ", ".join(f"{c} array<bigint>" for c in ("n_a", "n_b", "n_groups", "n_links", "sizes", "pairs", "pair_n"))
    blocks = written(
        docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).mapInArrow(
            aligned_blocks(*files, to_arrow_type(docs.schema[id_column].dataType)),
            f"block bigint, ids array<{kind}>, {numbers}, shas array<string>, chunk_of binary, links binary, pair_of binary"),
        "aligned", **PAGE_A_ROW)
    pairs = blocks.select("block", F.explode(F.arrays_zip("pairs", "pair_n")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), "p.pair_n")
    counted = pairs.select("block", "pair").join(link_counts(pairs), "pair").select(
        F.col("block").alias("of_block"), "pair", "n", "best")
    return blocks.drop("pairs", "pair_n").groupBy("block").cogroup(counted.groupBy("of_block")).applyInArrow(
        count_links,
        f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    ).withColumnRenamed("id", id_column)


def aligned_groups(docs: DataFrame, json_path: str, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per group of each text: id, start, end (bytes of space + text), a, b (ids in order).

    Texts that have no tokens (see `align_texts`) have no rows.
    """
    files = []
    for path in (json_path, model_path):
        with open(path, "rb") as file:
            files.append(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files)
        for batch in slices(batches, "text", BLOCK_BYTES):
            cut_texts = list(map(aligner.cut, pc.fill_null(batch.column("text"), "").to_pylist()))
            text_of_chunk = np.repeat(np.arange(len(cut_texts)), list(map(len, cut_texts)))
            a, count_a, b, count_b, good = aligner.encode([c for x in cut_texts for c in x])
            spelled = np.ones(len(cut_texts), bool)
            spelled[text_of_chunk[~good]] = False
            keep = spelled[text_of_chunk]
            a, b = a[np.repeat(keep, count_a)], b[np.repeat(keep, count_b)]
            size_a, size_b = aligner.of_a.size[a], aligner.of_b.size[b]
            end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
            group_a, group_b = coalesce(end_a, end_b, size_a, size_b)
            n = int(group_a[-1]) + 1 if len(a) else 0
            text = np.repeat(text_of_chunk[keep], count_a[keep])
            bounds_a, bounds_b = (np.searchsorted(g, np.arange(n + 1)) for g in (group_a, group_b))
            end = end_a[bounds_a[1:] - 1]
            owner = text[bounds_a[1:] - 1]
            base = np.append(0, end)[np.searchsorted(owner, owner)]
            yield pa.record_batch({
                "id": batch.column("id").take(pa.array(owner)),
                "start": pa.array(np.append(0, end)[:-1] - base), "end": pa.array(end - base),
                "a": pa.ListArray.from_arrays(pa.array(bounds_a, pa.int32()), pa.array(a, pa.int32())),
                "b": pa.ListArray.from_arrays(pa.array(bounds_b, pa.int32()), pa.array(b, pa.int32())),
            })

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).mapInArrow(
        run, f"id {kind}, {GROUPS}").withColumnRenamed("id", id_column)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_texts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
