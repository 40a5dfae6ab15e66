"""Hard negatives: scored pairs under packed keys, sorted in the shuffle, read once as a stream."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.tables import table, written
from tideline.session import shared_dir

ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
# Of a positive's score, in per cent.
LOWEST, HIGHEST = 50, 95
# Anchors are sent to all tasks in blocks of this many numbers (16 MB); scores of a block are made this many at a time.
BLOCK_NUMBERS, SCORES_AT_ONCE = 2 << 20, 2 << 20
BUFFERED = 1 << 18
LEAST, MOST = -(2**63) + 1, 2**63 - 1
PAIR = "anchor_id bigint, score bigint, negative boolean, id bigint"
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, exact; beyond 64 bits held at the ends of that range."""
    if left.shape[1] * np.abs(left).max(initial=0) * np.abs(right).max(initial=0) < 2.0**53:
        return left @ right.T
    exact = np.array([[int(x) for x in r] for r in left.tolist()], object) @ np.array([[int(x) for x in r] for r in right.tolist()], object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


class Best:
    """The first k entries of each slot by (score descending, id, null ids last); the rest is forgotten as it comes."""

    def __init__(self, slots: int, k: int) -> None:
        self.k, self.floor = k, np.full(slots, LEAST, np.int64)
        self.kept = [np.zeros(0, np.int64) for _ in range(5)]  # slot, score, null id, id, row
        self.parts: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(list(columns))
        self.waiting += len(columns[0])
        if self.waiting > BUFFERED:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        slot, score, null, ident, row = (np.concatenate([x, *(p[i] for p in self.parts)]) for i, x in enumerate(self.kept))
        order = np.lexsort((ident, null, -score, slot))
        first = np.searchsorted(slot[order], slot[order])
        place = np.arange(len(order)) - first
        order = order[place < self.k]
        self.kept = [x[order] for x in (slot, score, null, ident, row)]
        full = place[place < self.k] == self.k - 1
        self.floor[self.kept[0][full]] = self.kept[1][full]
        self.parts, self.waiting = [], 0
        return self.kept


class Anchors:
    """A block of anchors: ids, labels, vectors by length; with `windows`, the score ranges of each one's positives."""

    def __init__(self, block: pa.Table, windows: dict[int, list[tuple[int, int]]] | None = None) -> None:
        self.ids = block.column("id").to_numpy().astype(np.int64)
        self.labels = block.column("label").to_numpy().astype(np.int64)
        vectors = block.column("vector").to_pylist()
        sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
        self.by_size = {
            int(n): (at, whole(np.array([vectors[i] for i in at.tolist()], np.float64).reshape(len(at), int(n))))
            for n in np.unique(sizes) for at in [np.flatnonzero(sizes == n)]
        }
        # An anchor without that many windows has empty ranges in their place.
        self.low = np.ones((POSITIVES, len(self.ids)), np.int64)
        self.high = np.zeros((POSITIVES, len(self.ids)), np.int64)
        for i, ident in enumerate(self.ids.tolist() if windows else []):
            for j, (low, high) in enumerate(windows.get(ident, [])):
                self.low[j, i], self.high[j, i] = low, high


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * vectors)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Label, null id, id and vectors of the rows of a batch, by vector length."""
    column = batch.column("vector")
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    null = batch.column("id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    ident = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield label[at], null[at], ident[at], whole(flat[starts[at][:, None] + np.arange(n)])


def window(score: int) -> tuple[int, int]:
    """The scores a negative may have beside this positive score."""
    return -(-LOWEST * score // 100), HIGHEST * score // 100


def best_partners(anchors: Callable[[], Anchors], negatives: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs of a task's rows that can be among the first: 5 of the same label, or 3 of another in each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = anchors()
        best = Best(len(block.ids) * (POSITIVES if negatives else 1), NEGATIVES if negatives else POSITIVES)
        seen = 0
        for batch in batches:
            for label, null, ident, vectors in rows_of(batch):
                if vectors.shape[1] not in block.by_size:
                    continue
                at, matrix = block.by_size[vectors.shape[1]]
                step = max(1, SCORES_AT_ONCE // len(at))
                for s in range(0, len(label), step):
                    some = slice(s, s + step)
                    score = scores(matrix, vectors[some])
                    same = block.labels[at][:, None] == label[some][None, :]
                    for slot in range(POSITIVES if negatives else 1):
                        slots = slot * len(block.ids) + at
                        fits = score >= best.floor[slots][:, None]
                        if negatives:
                            fits &= ~same & (score >= block.low[slot][at][:, None]) & (score <= block.high[slot][at][:, None])
                        else:
                            fits &= same & ((block.ids[at][:, None] != ident[some][None, :]) | (null[some] > 0)[None, :])
                        i, j = np.nonzero(fits)
                        best.add(slots[i], score[i, j].astype(np.int64), null[some][j], ident[some][j], seen + s + j)
                seen += len(label)
        slot, score, null, ident, row = best.settle()
        anchor = slot % max(1, len(block.ids))
        # A negative may be in several windows of an anchor: one row is enough.
        once = np.unique(np.stack([anchor, row]), axis=1, return_index=True)[1]
        yield pa.record_batch({
            "anchor_id": pa.array(block.ids[anchor[once]], pa.int64()), "score": pa.array(score[once], pa.int64()),
            "negative": pa.array(np.full(len(once), negatives)), "id": pa.array(ident[once], pa.int64(), mask=null[once] > 0),
        })

    return run


# Anchor, score from the top, negatives after positives, null ids last, id: bytes in the order of the stream.
KEY = ">QQBBQ"


def pack(anchor: int, score: int, negative: bool, ident: int | None) -> bytes:
    return struct.pack(KEY, anchor + 2**63, MOST - score, negative, ident is None, (ident or 0) + 2**63)


def unpack(key: bytes) -> tuple[int, int, int, int | None]:
    anchor, score, negative, null, ident = struct.unpack(KEY, key)
    return anchor - 2**63, MOST - score, negative, None if null else ident - 2**63


def mine(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
    """One pass over sorted keys: a positive opens a window, a negative goes to the open windows it fits."""
    current, opened, windows = None, 0, []
    for key, _ in keys:
        anchor, score, negative, ident = unpack(key)
        if anchor != current:
            current, opened, windows = anchor, 0, []
        if negative:
            for w in windows:
                if w["found"] < NEGATIVES and w["low"] <= score <= w["high"]:
                    w["found"] += 1
                    yield anchor, w["id"], w["found"], ident, w["score"], score
            windows = [w for w in windows if w["found"] < NEGATIVES and w["low"] <= score]
        elif opened < POSITIVES:
            opened += 1
            low, high = window(score)
            windows.append({"id": ident, "score": score, "low": low, "high": high, "found": 0})


def candidates(rows: DataFrame) -> DataFrame:
    """The rows that take part (id, label, vector); of rows that share an id the one with the least label, then vector."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite)
    named = valid.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return named.select("id", "row.label", "row.vector").unionByName(valid.where(F.col("id").isNull()))


def hard_negatives(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label: Column | str = "label",
    anchor_every: int = ANCHOR_EVERY,
) -> DataFrame:
    """For each anchor and each of its positives, its hard negatives (`MINED`), ranked from 1.

    Anchors are the rows whose id is divisible by `anchor_every`. A score is the inner product of
    floor(256 * x). Positives are an anchor's first 5 others of its label, negatives of a positive the
    first 3 of other labels whose score is 50 to 95 per cent of the positive's; higher scores come
    first, then smaller ids, null ids last.

    Anchors go out in blocks of bounded size. All rows are scored against a block twice: for the
    positives, then for negatives inside the windows that these open. A task passes on only what can
    be among its anchors' first ones, so what is shuffled grows with anchors and tasks, not with pairs,
    and neither a common label nor a common vector meets in one task. The pairs' packed keys are sorted
    by the shuffle itself, and a pass over them emits the negatives; no anchor's pairs are gathered.

    Rows with a null label or vector, or a null, NaN or infinite component take no part. Rows with one
    id are one row (see `candidates`); rows without an id take part, but are no anchors. Vectors of
    different lengths have no score; labels are whole numbers. Other columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    named = rows.select(
        F.col(id_column).cast("bigint").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        F.col(vector_column).alias("vector"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    all_rows = written(candidates(named).repartition(tasks), "vectors")
    anchors = all_rows.where(F.col("id") % anchor_every == 0)
    numbers = anchors.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    blocks = -(-numbers // BLOCK_NUMBERS)
    anchors = written(anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, blocks)))).repartition("block"), "anchors")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    folder = shared_dir(spark, "pairs")
    for number in range(blocks):
        block = anchors.where(F.col("block") == number).select("id", "label", "vector").toArrow()
        sent = spark.sparkContext.broadcast(block)
        positives = all_rows.mapInArrow(best_partners(lambda sent=sent: Anchors(sent.value), False), PAIR)
        positives = positives.withColumn("place", F.row_number().over(first)).where(F.col("place") <= POSITIVES)
        positives.drop("place").write.parquet(f"{folder}/block-{number}/positives")
        windows: dict[int, list[tuple[int, int]]] = {}
        for row in spark.read.schema(PAIR).parquet(f"{folder}/block-{number}/positives").where("score >= 0").select("anchor_id", "score").collect():
            windows.setdefault(row.anchor_id, []).append(window(row.score))
        opened = spark.sparkContext.broadcast(windows)
        found = all_rows.mapInArrow(best_partners(lambda sent=sent, opened=opened: Anchors(sent.value, opened.value), True), PAIR)
        found.write.parquet(f"{folder}/block-{number}/negatives")
        sent.destroy()
        opened.destroy()
    if not blocks:
        return spark.createDataFrame([], MINED)
    pairs = spark.read.schema(PAIR).option("recursiveFileLookup", "true").parquet(folder)
    keys = pairs.rdd.map(lambda r: (pack(r[0], r[1], r[2], r[3]), None))
    mined = keys.repartitionAndSortWithinPartitions(tasks, lambda key: zlib.crc32(key[:8])).mapPartitions(mine)
    return spark.createDataFrame(mined, MINED, verifySchema=False)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


OP13_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id, score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT o.anchor_id, o.id AS positive_id,
       (row_number() OVER w)::INTEGER AS rank,
       n.id AS negative_id, o.score AS positive_score, n.score AS negative_score
FROM positives o JOIN p n
  ON n.anchor_id = o.anchor_id AND NOT n.same
 AND 50 * o.score <= 100 * n.score AND 100 * n.score <= 95 * o.score
WINDOW w AS (PARTITION BY o.anchor_id, o.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 3
"""
