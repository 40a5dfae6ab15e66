"""Benchmark passages in documents: latent semantic search, then subsequence and answer checks.

Words become one of 2**13 hashed features, kept as a table. Passages of 24 words are TF-IDF rows
of a matrix A that no task ever holds. A randomised sketch Y = A'(A W), summed over tasks, gives
the leading right singular vectors: with C the Cholesky factor of W'Y, the left singular vectors of
Y C^-T are those of A'A, and their singular values squared its eigenvalues (the Nystrom form, one
pass). Windows of documents and of the benchmark are compared by cosine in this latent space,
scaled by the singular values. Candidates then pass two exact checks on word features: the longest
common subsequence of the benchmark text with the surroundings of the window, and the rarest
words of the benchmark text, taken as its answer, half of which must be there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import SpanHash, lowered, mixed, slices, text_bytes
from tideline.llm.tables import table, unused, whole_text, written

FEATURE_BITS = 13
FEATURES = 1 << FEATURE_BITS
RANK = 64
PASSAGE, STRIDE, WINDOW_STEP = 24, 12, 4
LONGEST = 60
COSINE = 0.5
COMMON_SHARE = 0.5
ANSWER_WORDS, ANSWER_SHARE = 8, 0.5
FEWEST_WORDS = 6
BENCHMARK_BLOCK = 2000
# The sketch sums words of a feature with more of them than this in a slice by a product of matrices.
MANY_WORDS = 24
# A task passes on its share of the sketch, which covers all rows, after so many of them and at its end.
SKETCH_ROWS = 50_000


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first of each row (and one more).

    Words are runs of letters and digits; punctuation beyond ASCII parts them too. Of scripts written
    without spaces (Chinese, Japanese, Thai, Lao) each character is a word.
    """
    solid = np.zeros(256, bool)
    solid[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    solid = solid[data]
    second, third = (np.append(data[k:], np.zeros(min(k, len(data)), np.uint8)) for k in (1, 2))
    latin = (data == 0xC2) & (second >= 0xA0) & ~np.isin(second, (0xAA, 0xB5, 0xBA))
    full = (data == 0xEF) & np.where(second == 0xBC, (third < 0x90) | (third >= 0x9A) & (third < 0xA1) | (third >= 0xBB), (
        second == 0xBD) & ((third == 0x80) | (third >= 0x9B) & (third < 0xA6)))
    general = (data == 0xE2) & (second <= 0x81) | (data == 0xE3) & (second == 0x80) | full
    for mark, size in ((latin, 2), (general, 3)):
        for at in np.flatnonzero(mark)[None, :] + np.arange(size)[:, None]:
            solid[at] = False
    wide = ((data >= 0xE3) & (data <= 0xE9) | (data == 0xE0) & np.isin(second, (0xB8, 0xB9, 0xBA, 0xBB))) & solid
    cut = np.zeros(len(data) + 3, bool)
    cut[offsets] = True
    lead = np.flatnonzero(wide)
    cut[lead] = cut[lead + 3] = True
    cut = cut[: len(data) + 1]
    starts = np.flatnonzero(solid & (cut[:-1] | ~np.append(False, solid[:-1])[: len(data)]))
    ends = np.flatnonzero(solid & (cut[1:] | ~np.append(solid[1:], False)[: len(data)])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, hashes: SpanHash) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the first word of each row."""
    data = lowered(data)
    starts, ends, first = word_spans(data, offsets)
    hashes.load(data)
    return hashes.spans(starts, ends), first


def sequences(word: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` words in a row of words, by the place of the first."""
    count = max(len(word) - size + 1, 0)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = mixed(out) + word[k: k + count]
    return out


def featurize(short: list[tuple[int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """id, features, and the items of `short` (item, words, hash of the words) that the row holds word by word."""
    by_size: dict[int, dict[int, list[int]]] = {}
    for item, size, value in short:
        by_size.setdefault(size, {}).setdefault(value, []).append(item)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = SpanHash()
        for batch in slices(batches, "text"):
            word, first = word_hashes(*text_bytes(batch.column("text")), hashes)
            features = (word >> np.uint64(64 - FEATURE_BITS)).astype(np.uint16)
            places = pa.array((first * 2).astype(np.int32)).buffers()[1]
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, places, pa.py_buffer(features.tobytes())])
            held: list[set[int]] = [set() for _ in range(batch.num_rows)]
            for size, items in by_size.items():
                found = sequences(word, size)
                at = np.flatnonzero(np.isin(found, np.array(list(items), np.uint64)))
                row = np.searchsorted(first, at, side="right") - 1
                inside = at + size <= first[row + 1]
                for r, value in zip(row[inside].tolist(), found[at[inside]].tolist(), strict=True):
                    held[r].update(items[value])
            yield pa.record_batch({"id": batch.column("id"), "features": packed, "short": pa.array([sorted(x) for x in held], pa.list_(pa.int64()))})

    return run


def list_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, number of words and hash of the items too short for the search."""
    hashes = SpanHash()
    for batch in slices(batches, "text"):
        word, first = word_hashes(*text_bytes(batch.column("text")), hashes)
        size = np.diff(first)
        some = np.flatnonzero((size > 0) & (size < FEWEST_WORDS))
        value = [int(sequences(word[first[r]: first[r + 1]], size[r])[0]) for r in some]
        yield pa.record_batch({"id": batch.column("id").take(pa.array(some)), "size": size[some], "value": np.array(value, np.uint64).view(np.int64)})


def feature_rows(batches: Iterator[pa.RecordBatch], limit: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each slice with its features end to end and the place of each row's first."""
    for batch in slices(batches, "features", limit):
        raw, offsets = text_bytes(batch.column("features"))
        yield batch, raw.view(np.uint16), offsets // 2


def block_starts(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of `width` words that begin anew in each row, and the row of each block."""
    counts = -(-np.diff(first) // width)
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[row] + within * width, row


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """feature, passages of this task with it; feature -1 counts all passages."""
    total, passages = np.zeros(FEATURES, np.int64), 0
    for _, features, first in feature_rows(batches):
        starts, _ = block_starts(first, PASSAGE)
        whose = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(features))))
        pairs = np.sort(whose << FEATURE_BITS | features)
        total += np.bincount(pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]] & (FEATURES - 1), minlength=FEATURES)
        passages += len(starts)
    some = np.flatnonzero(total)
    yield pa.record_batch({"feature": np.append(some, -1).astype(np.int64), "n": np.append(total[some], passages).astype(np.int64)})


def add_by_feature(total: np.ndarray, latent: np.ndarray, features: np.ndarray, whose: np.ndarray) -> None:
    """Add to the row of each word's feature in `total` the row of `latent` of its passage, `whose`.

    Features with many words are counted by passage and multiplied, the others summed word by word.
    """
    order = np.argsort(features, kind="stable")
    begin = np.flatnonzero(np.append(True, features[order[1:]] != features[order[:-1]]))
    size = np.diff(np.append(begin, len(order)))
    feature, many = features[order[begin]], size > MANY_WORDS
    if many.any():
        place = np.full(FEATURES, -1, np.int64)
        place[feature[many]] = np.arange(many.sum())
        at = place[features]
        pairs = at[at >= 0] * len(latent) + whose[at >= 0]
        counts = np.bincount(pairs, minlength=many.sum() * len(latent)).astype(np.float32)
        total[feature[many]] += counts.reshape(-1, len(latent)) @ latent
    begin, size, feature = begin[~many], size[~many], feature[~many]
    if len(begin):
        by_size = np.argsort(-size, kind="stable")
        begin, size, feature = begin[by_size], size[by_size], feature[by_size]
        part = np.zeros((len(begin), latent.shape[1]), np.float32)
        for k in range(size[0]):
            some = np.searchsorted(-size, -k)  # features with more than k words
            part[:some] += latent[whose[order[begin[:some] + k]]]
        total[feature] += part


def sketcher(weights: np.ndarray, probe: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task's share of A'(A W), as rows (block, values) of 256 features each."""

    def share(total: np.ndarray) -> pa.RecordBatch:
        return blocks_of(dict(enumerate((total * weights[:, None]).reshape(FEATURES // 256, -1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = (probe * weights[:, None]).astype(np.float32)
        square = (weights * weights).astype(np.float32)
        total = np.zeros((FEATURES, RANK))
        rows = 0
        for batch, features, first in feature_rows(batches, 1 << 16):
            if not len(features):
                continue
            rows += batch.num_rows
            starts, _ = block_starts(first, PASSAGE)
            latent = block_sums(weighted, features, starts, PASSAGE)
            latent /= np.maximum(np.add.reduceat(square[features], starts), 1e-9)[:, None]
            whose = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(features))))
            add_by_feature(total, latent, features, whose)
            if rows >= SKETCH_ROWS:
                yield share(total)
                total[:], rows = 0, 0
        if rows:
            yield share(total)

    return run


def blocks_of(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch({
        "block": pa.array(list(parts), pa.int64()),
        "part": pa.array([x.astype(np.float64).tobytes() for x in parts.values()], pa.binary()),
    })


def add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums rows of one block; holds one block of each number at most."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True):
            values = np.frombuffer(part, np.float64)
            parts[block] = parts[block] + values if block in parts else values
    if parts:
        yield blocks_of(parts)


def latent_space(features: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """idf weight of each feature, and the matrix that takes weighted words to scaled latent vectors.

    Weights and directions come from the passages of all rows. The driver gets sums of fixed size only: 2**13 counts and 2**13 rows of 64 numbers.
    """
    counts = {r.feature: r.n for r in features.select("features").mapInArrow(
        count_features, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    passages = counts.pop(-1, 0)
    weights = np.full(FEATURES, np.log((passages + 1) / 1.0) + 1)
    for feature, n in counts.items():
        weights[feature] = np.log((passages + 1) / (n + 1)) + 1
    probe = np.random.default_rng(20240101).standard_normal((FEATURES, RANK))
    width = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = features.select("features").mapInArrow(sketcher(weights, probe), "block long, part binary")
    salted = shares.withColumn("salt", F.spark_partition_id() % 16).repartition(width, "block", "salt").drop("salt")
    summed = salted.mapInArrow(add_blocks, "block long, part binary").repartition(width, "block").mapInArrow(
        add_blocks, "block long, part binary")
    sketch = np.zeros((FEATURES // 256, 256 * RANK))
    for row in summed.collect():
        sketch[row.block] += np.frombuffer(row.part, np.float64)
    sketch = sketch.reshape(FEATURES, RANK)
    core = probe.T @ sketch
    scale = max(float(np.trace(core)), 1e-9)
    factor = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * scale * np.eye(RANK))
    left, values, _ = np.linalg.svd(np.linalg.solve(factor, sketch.T).T, full_matrices=False)
    return weights, (left / np.maximum(values, 1e-6 * max(values[0], 1e-9))).astype(np.float32)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def common_subsequence(left: np.ndarray, sizes: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of `left` (its first `sizes` values) and of `right`.

    Bit-parallel over the up to 64 places of the left row; -1 in `right` matches nothing.
    """
    state = np.full(len(left), np.uint64(0xFFFFFFFFFFFFFFFF))
    padded = np.full((len(left), 64), -2, np.int32)
    padded[:, : left.shape[1]] = left
    padded[np.arange(64) >= sizes[:, None]] = -2
    for k in range(right.shape[1]):
        match = np.packbits(padded == right[:, k: k + 1], axis=1, bitorder="little").view(np.uint64)[:, 0]
        used = state & match
        state = (state + used) | (state - used)
    return np.unpackbits(np.ascontiguousarray(~state).view(np.uint8).reshape(len(left), 8), axis=1).sum(axis=1)


def block_sums(values: np.ndarray, features: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Sum of the rows of `values` for the words of each block of up to `width` words."""
    sizes = np.diff(np.append(starts, len(features)))
    total = np.zeros((len(starts), values.shape[1]), values.dtype)
    for k in range(width):
        if (full := sizes > k).all():
            total += values[features[starts + k]]
        else:
            at = np.flatnonzero(full)
            total[at] += values[features[starts[at] + k]]
    return total


def surroundings(features: np.ndarray, first: np.ndarray, starts: np.ndarray, row: np.ndarray, margin: int = LONGEST) -> np.ndarray:
    """The words of a window and of the places on both sides, -1 outside of the row."""
    places = starts[:, None] + np.arange(-margin, PASSAGE + margin)
    inside = (places >= first[row][:, None]) & (places < first[row + 1][:, None])
    return np.where(inside, features[np.clip(places, 0, len(features) - 1)].astype(np.int32), -1)


class Benchmark:
    """Texts of the benchmark as chunks of up to 60 words, with latent windows and answer words."""

    def __init__(self, items: list[tuple[int, np.ndarray]], weights: np.ndarray, space: np.ndarray) -> None:
        self.item, chunks, self.window_chunk, vectors = [], [], [], []
        word = space.astype(np.float64) * weights[:, None]
        for item, features in items:
            for at in range(0, max(len(features) - LONGEST // 2, 1), LONGEST // 2):
                chunk = features[at: at + LONGEST].astype(np.int32)
                if len(chunk) < FEWEST_WORDS:
                    continue
                for start in [*range(0, max(len(chunk) - PASSAGE, 0), WINDOW_STEP), max(len(chunk) - PASSAGE, 0)]:
                    vectors.append(word[chunk[start: start + PASSAGE]].sum(axis=0))
                    self.window_chunk.append(len(chunks))
                self.item.append(item)
                chunks.append(chunk)
        self.windows = unit(np.array(vectors).reshape(-1, space.shape[1])).astype(np.float32)
        self.window_chunk = np.array(self.window_chunk, np.int64)
        self.size = np.array([len(c) for c in chunks], np.int64)
        self.chunk = np.full((len(chunks), LONGEST), -2, np.int32)
        self.answer = np.full((len(chunks), ANSWER_WORDS), -2, np.int32)
        self.answer_size = np.zeros(len(chunks), np.int64)
        for k, chunk in enumerate(chunks):
            self.chunk[k, : len(chunk)] = chunk
            rare = np.unique(chunk)
            rare = rare[np.argsort(-weights[rare], kind="stable")][: min(ANSWER_WORDS, max(len(chunk) // 4, 2))]
            self.answer[k, : len(rare)] = rare
            self.answer_size[k] = len(rare)


def searcher(bench: Benchmark, weights: np.ndarray, space: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The items found in each row of (row, id, features, short), with their best cosine and common share."""
    word = (space * weights[:, None]).astype(np.float32)

    def answered(features: np.ndarray, first: np.ndarray, starts: np.ndarray, row: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """Places of the candidates, in order of their windows, with half of the answer words around the window."""
        begin = np.flatnonzero(np.append(True, starts[1:] != starts[:-1])[: len(starts)])
        whose = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(starts))))
        passed = [np.zeros(0, np.int64)]
        for low in range(0, len(begin), 512):
            part = begin[low: low + 512]
            around = surroundings(features, first, starts[part], row[part])
            holds = np.zeros((len(part), FEATURES + 2), bool)  # columns -1 and -2 stand for no word
            holds[np.arange(len(part))[:, None], around] = True
            holds[:, FEATURES:] = False
            at = np.arange(part[0], begin[low + 512] if low + 512 < len(begin) else len(starts))
            there = np.zeros(len(at), np.int64)
            for k in range(ANSWER_WORDS):
                there += holds[whose[at] - low, bench.answer[chunk[at], k]]
            passed.append(at[there >= ANSWER_SHARE * bench.answer_size[chunk[at]]])
        return np.concatenate(passed)

    def hits(features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        starts, row = block_starts(first, STRIDE)
        sums = block_sums(word, features, starts, STRIDE)
        follows = np.append(row[1:] == row[:-1], False)
        alone = ~follows & ~np.append(False, row[1:] == row[:-1])
        at = np.flatnonzero(follows | alone)
        vectors = sums[at]
        vectors[follows[at]] += sums[at[follows[at]] + 1]
        vectors = unit(vectors)
        met = []
        for low in range(0, len(at), 2048):
            cosine = (vectors[low: low + 2048] @ bench.windows.T).ravel()
            over = np.flatnonzero(cosine >= COSINE)
            near, window = np.divmod(over, len(bench.windows))
            met.append((near + low, bench.window_chunk[window], cosine[over]))
        near, chunk, value = (np.concatenate(x) for x in zip(*met, strict=True)) if met else (np.zeros(0, np.int64),) * 3
        _, once = np.unique(near * len(bench.size) + chunk, return_index=True)
        near, chunk, value = at[near[once]], chunk[once], value[once]
        passed = answered(features, first, starts[near], row[near], chunk)
        near, chunk, value = near[passed], chunk[passed], value[passed]
        share = np.zeros(len(near))
        for low in range(0, len(near), 4096):
            n, c = near[low: low + 4096], chunk[low: low + 4096]
            share[low: low + 4096] = common_subsequence(
                bench.chunk[c], bench.size[c], surroundings(features, first, starts[n], row[n])) / bench.size[c]
        enough = share >= COMMON_SHARE
        return row[near[enough]], chunk[enough], value[enough], share[enough]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, features, first in feature_rows(batches, 1 << 17):
            row, chunk, cosine, common = hits(features, first) if len(features) and len(bench.size) else (np.zeros(0, np.int64),) * 4
            items: list[list[int]] = batch.column("short").to_pylist()
            score = np.array([float(len(x) > 0) for x in items])
            best = score.copy()
            for r, c, x, y in zip(row.tolist(), chunk.tolist(), cosine.tolist(), common.tolist(), strict=True):
                if bench.item[c] not in items[r]:
                    items[r].append(bench.item[c])
                score[r], best[r] = max(score[r], x), max(best[r], y)
            yield pa.record_batch({
                "row": batch.column("row"),
                "id": batch.column("id"),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
                "cosine": pa.array(score),
                "common_share": pa.array(best),
            })

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, contaminated, items, cosine, common_share.

    `items` are the sorted ids of the benchmark items found, `cosine` (of the first
    benchmark window met) and `common_share` the greatest among them (0 if none). Letters of all scripts
    are compared in lower case. Null texts count as empty and contain nothing; items of fewer
    than six words are found where the same words follow each other (cosine and share 1); items
    without a word or an id are not searched for. The benchmark is the query set: it is
    searched in blocks of 2,000 items, each block against all rows. Repeated rows get equal results.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    query = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("id"), F.lower(whole_text("text")).alias("text"))
    # Fewer numbers than the benchmark, the query set, has items.
    short = [(r.id, r["size"], r.value % (1 << 64)) for r in query.mapInArrow(list_short, "id long, size long, value long").collect()]
    texts = docs.select(F.col(id_column).alias("id"), F.lower(whole_text(text_column)).alias("text"))
    # Numbered once, in what is written: blocks of the benchmark meet by row, whatever the ids.
    features = written(
        texts.mapInArrow(featurize(short), f"id {id_type}, features binary, short array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()), "features")
    weights, space = latent_space(features)
    wanted = written(query.mapInArrow(featurize([]), "id long, features binary, short array<bigint>"), "benchmark-features")
    blocks = max(-(-wanted.count() // BENCHMARK_BLOCK), 1)
    found = None
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        items = sorted((r.id, bytes(r.features)) for r in rows)
        bench = Benchmark([(i, np.frombuffer(x, np.uint16)) for i, x in items], weights, space)
        part = features.mapInArrow(
            searcher(bench, weights, space), f"row bigint, id {id_type}, items array<bigint>, cosine double, common_share double")
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = merge_blocks(written(found, "found-blocks"))
    return found.select(
        F.col("id").alias(id_column), (F.size("items") > 0).alias("contaminated"), "items", "cosine", "common_share")


def merge_blocks(found: DataFrame) -> DataFrame:
    """One row per input row from the rows of all blocks."""
    return found.groupBy("row").agg(
        F.first("id").alias("id"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("cosine").alias("cosine"), F.max("common_share").alias("common_share"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The input rows without those whose id has a contaminated row; a row without an id is judged by its text."""
    mark = unused("_judged", docs.columns)
    by_text = F.concat(F.lit("text "), F.sha2(whole_text(text_column).cast("binary"), 256))
    marked = docs.withColumn(mark, F.coalesce(F.col(id_column).cast("string"), by_text))
    found = contamination(marked, benchmark, mark, text_column).where("contaminated").select(mark).distinct()
    return marked.join(found, mark, "left_anti").select(docs.columns)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
