"""Byte-pair pieces of a sentencepiece model: vectorised merge rounds, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import mixed, slices
from tideline.llm.tables import table, whole_text

SPACE = "▁"
NONE = np.iinfo(np.int64).max
LONG_WORD = 256
KEPT_WORDS = 200_000
TABLE_BITS = 20


class Pieces:
    """Vocabulary as arrays: piece of an id, merged id and rank of a pair of ids.

    Ranks follow the scores, equal scores sharing a rank. Characters that are no piece get ids
    above the vocabulary, so that pairs with them have a number too; they leave as bytes.
    """

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.count = processor.get_piece_size()
        self.surface, self.byte_of, self.of_byte, self.id_of = [], {}, {}, {}
        scores = np.zeros(self.count)
        for i in range(self.count):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
                self.of_byte[self.byte_of[i]] = i
            elif processor.is_control(i):
                piece = ""
            elif processor.is_unknown(i):
                piece = processor.decode([i])
            else:
                self.id_of[piece] = i
                scores[i] = processor.get_score(i)
            self.surface.append(piece.replace(SPACE, " "))
        # Text is cut before each run of spaces; a piece must not reach across such a cut.
        self.cut_safe = not any(SPACE in x.lstrip(SPACE) for x in self.id_of)
        ranks = np.unique(-scores, return_inverse=True)[1]
        symbols = dict(self.id_of)
        for piece in self.id_of:
            for c in piece:
                symbols.setdefault(c, len(symbols) + self.count)
        self.symbol_of = symbols
        self.base = max([self.count, *symbols.values()]) + 0x110000 + 1
        # Symbol of each code point, and which ids stand for bytes.
        self.of_point = np.arange(0x110000, dtype=np.int64) + (self.base - 0x110000)
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_point[ord(c)] = i
        self.is_high_byte = np.zeros(self.count, bool)
        for i, byte in self.byte_of.items():
            self.is_high_byte[i] = byte > 127
            self.surface[i] = chr(byte) if byte < 128 else ""
        pairs = []
        for piece, i in self.id_of.items():
            for at in range(1, len(piece)):
                left, right = symbols.get(piece[:at]), symbols.get(piece[at:])
                if left is not None and right is not None:
                    pairs.append((left * self.base + right, i, ranks[i]))
        pairs.sort()
        self.pair_key, self.pair_id, self.pair_rank = (
            np.array([x[k] for x in pairs], np.int64) for k in range(3))
        self.index_pairs()

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged id and rank of each pair; rank NONE where the pair makes no piece."""
        if not len(self.pair_key):
            return np.zeros(len(left), np.int64), np.full(len(left), NONE)
        key = left * self.base + right
        at = self.tables[0][self.slot(key, 0)]
        other = np.flatnonzero(self.pair_key[at] != key)
        at[other] = self.tables[1][self.slot(key[other], 1)]
        return self.pair_id[at], np.where(self.pair_key[at] == key, self.pair_rank[at], NONE)

    def slot(self, key: np.ndarray, which: int) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(self.factors[which]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def index_pairs(self) -> None:
        """Two hash tables of the pairs: the second has those that lost their slot in the first."""
        for seed in range(1000):
            self.factors = [int(x) | 1 for x in mixed(np.arange(2) + 2 * seed)]
            self.tables = [np.zeros(1 << TABLE_BITS, np.int32), np.zeros(1 << TABLE_BITS, np.int32)]
            left = np.arange(len(self.pair_key))
            for which in (0, 1):
                slots = self.slot(self.pair_key[left], which)
                self.tables[which][slots] = left
                left = left[self.tables[which][slots] != left]
            if not len(left):
                return
        raise ValueError("too many pairs for the tables")

    def symbols(self, text: str) -> np.ndarray:
        return self.of_point[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def ids(self, symbols: Iterable[int]) -> list[int]:
        """Ids of merged symbols: a character outside the vocabulary becomes its UTF-8 bytes."""
        out, first_free = [], self.base - 0x110000
        for x in symbols:
            if x < self.count:
                out.append(x)
                continue
            c = chr(x - first_free) if x >= first_free else next(c for c, i in self.symbol_of.items() if i == x)
            out.extend(self.of_byte[b] for b in c.encode()) if self.of_byte else out.append(0)
        return out

    def split(self, text: str) -> list[str]:
        """The words of a text: each begins with its run of spaces, the first one with a space added."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return re.findall(f"{SPACE}+[^{SPACE}]*", marked) if self.cut_safe else [marked]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of each word's ids."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbol, word = self.symbols("".join(words)), np.repeat(np.arange(len(words)), lengths)
        short = (lengths <= LONG_WORD)[word]
        parts = [merge_in_rounds(self, symbol[short], word[short])]
        for i in np.flatnonzero(lengths > LONG_WORD):
            merged = merge_by_heap(self, symbol[word == i].tolist())
            parts.append((np.array(merged, np.int64), np.full(len(merged), i)))
        symbol, word = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        symbol, word = symbol[order], word[order]
        foreign = np.flatnonzero(symbol >= self.count)
        if len(foreign):
            width = np.ones(len(symbol), np.int64)
            spelled = [self.ids([x]) for x in symbol[foreign].tolist()]
            width[foreign] = list(map(len, spelled))
            first = np.cumsum(width) - width
            symbol, word = np.repeat(symbol, width), np.repeat(word, width)
            for at, ids in zip(first[foreign].tolist(), spelled, strict=True):
                symbol[at: at + len(ids)] = ids
        return symbol.astype(np.int32), np.bincount(word, minlength=len(words))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, without the space that encoding put in front."""
        parts, pending = [], bytearray()
        if not self.is_high_byte[ids].any():
            text = "".join(map(self.surface.__getitem__, ids.tolist()))
        else:
            for i in ids.tolist():
                if i in self.byte_of:
                    pending.append(self.byte_of[i])
                    continue
                if pending:
                    parts.append(pending.decode("utf-8", "replace"))
                    pending.clear()
                parts.append(self.surface[i])
            parts.append(pending.decode("utf-8", "replace"))
            text = "".join(parts)
        return text[1:] if text.startswith(" ") else text


def merge_in_rounds(pieces: Pieces, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges the symbols of all words at once; returns the symbols left and their words, word by word.

    The symbols of all words lie in one array. A round finds the smallest pair rank of each word
    and merges the occurrences of that pair from the left. Where a merge makes a pair of no greater
    rank, the word merges its leftmost occurrence only, since that new pair may come first. Words
    without a pair leave the array.
    """
    done: list[tuple[np.ndarray, np.ndarray]] = [(symbol[:0], word[:0])]
    while len(symbol):
        merged, rank = pieces.lookup(symbol[:-1], symbol[1:])
        rank = np.append(np.where(word[:-1] == word[1:], rank, NONE), NONE)
        merged = np.append(merged, 0)
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(rank, start)
        size = np.diff(np.append(start, len(symbol)))
        over = best == NONE
        open_ = np.repeat(~over, size)
        done.append((symbol[~open_], word[~open_]))
        if not open_.any():
            break
        target = np.repeat(best, size)[open_]
        symbol, word, rank, merged = symbol[open_], word[open_], rank[open_], merged[open_]

        hit = rank == target
        place = np.arange(len(symbol))
        run_start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, -1))
        chosen = hit & ((place - run_start) % 2 == 0)
        at = np.flatnonzero(chosen)
        left, right = at - 1, at + 2
        has_left = (left >= 0) & (word[np.maximum(left, 0)] == word[at])
        has_right = (right < len(symbol)) & (word[np.minimum(right, len(symbol) - 1)] == word[at])
        joined = has_left & chosen[np.maximum(at - 2, 0)] & (at >= 2) & (word[np.maximum(at - 2, 0)] == word[at])
        early = has_left & (pieces.lookup(symbol[np.maximum(left, 0)], merged[at])[1] <= target[at])
        early |= has_right & (pieces.lookup(merged[at], symbol[np.minimum(right, len(symbol) - 1)])[1] <= target[at])
        early |= joined & (pieces.lookup(merged[np.maximum(at - 2, 0)], merged[at])[1] <= target[at])
        if early.any():
            careful = np.isin(word[at], word[at[early]])
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            at = at[~careful | first]
        symbol = symbol.copy()
        symbol[at] = merged[at]
        stays = np.ones(len(symbol), bool)
        stays[at + 1] = False
        symbol, word = symbol[stays], word[stays]
    return tuple(np.concatenate([x[k] for x in done]) for k in (0, 1))


def merge_by_heap(pieces: Pieces, symbols: list[int]) -> list[int]:
    """The same merges for one long word: a queue by rank, then place."""
    before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    alive = [True] * len(symbols)
    table = dict(zip(pieces.pair_key.tolist(), zip(pieces.pair_rank.tolist(), pieces.pair_id.tolist(), strict=True), strict=True))
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        found = table.get(symbols[i] * pieces.base + symbols[j]) if j >= 0 else None
        if found:
            heapq.heappush(queue, (found[0], i, symbols[i], symbols[j], found[1]))

    for i in range(len(symbols)):
        offer(i)
    while queue:
        _, i, x, y, merged = heapq.heappop(queue)
        j = after[i]
        if not alive[i] or symbols[i] != x or j < 0 or symbols[j] != y:
            continue
        symbols[i], alive[j], after[i] = merged, False, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s, a in zip(symbols, alive, strict=True) if a]


def encoder(model: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ids and decoded text to batches of (id, text); words met before are remembered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        known: dict[str, int] = {}
        flat, size = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in slices(batches, "text", 1 << 20):
            split = [pieces.split(t) for t in pc.fill_null(batch.column("text"), "").to_pylist()]
            if len(known) > KEPT_WORDS:
                known.clear()
                flat, size = flat[:0], size[:0]
            new = list({w for ws in split for w in ws if w not in known})
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            more, sizes = pieces.encode_words(new)
            flat, size = np.concatenate([flat, more]), np.concatenate([size, sizes])
            counts = list(map(len, split))
            word = np.fromiter((known[w] for ws in split for w in ws), np.int64, sum(counts))
            length = size[word]
            at = np.cumsum(length) - length
            ids = flat[np.repeat((np.cumsum(size) - size)[word] - at, length) + np.arange(int(length.sum()))]
            ends = np.append(0, np.cumsum(length))[np.cumsum([0, *counts])]
            yield pa.record_batch({
                "id": batch.column("id"),
                "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                "decoded": pa.array([pieces.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()),
            })

    return run


def encode_texts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ids (array of int), decoded.

    Ids are those of the sentencepiece library for a BPE model with identity normalisation, without
    begin and end ids; decoded is its decoding of them. Spaces become U+2581 and one is put in
    front; a null or empty text has no ids. Words of up to 256 characters are merged in vectorised
    rounds, longer ones by a queue, whose cost does not grow with the square of their length.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    return docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).mapInArrow(
        encoder(model), f"id {docs.schema[id_column].dataType.simpleString()}, ids array<int>, decoded string",
    ).withColumnRenamed("id", id_column)


def token_digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_column,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(encode_texts(table(spark, sf_dir, "documents"), default_model()))
