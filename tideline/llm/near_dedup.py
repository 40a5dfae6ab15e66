"""Near duplicates: MinHash signatures joined by Hamming distance, links confirmed on full sets.

A signature has 64 symbols of 16 bits, cut into 16 chunks of 4. Two signatures that differ in at
most 31 symbols differ in at most one symbol of some chunk, for 16 chunks with two or more errors
make 32. So every chunk is indexed once for each symbol it may have wrong, with that symbol left
out, and every pair within the distance meets in some bucket. At a Jaccard similarity of 0.75 a
symbol differs with probability 0.25, so 31 of 64 lies 4.3 standard deviations above the mean.

Buckets are joined without forming all their pairs. First each member is compared with the
smallest member of its bucket only, and the links found merge most of a group of copies into one
component. The members of buckets that still hold several components are left over. A bucket of
half-similar documents has a quadratic number of pairs, nearly all of them no links; so a pair
of left-over members from different components is looked at only if it can be a link: the rarest
shingles of the two meet. With the shingles of a set in order of rarity, two sets of similarity t
share one among the first (1 - t) n + 1 of the longer and the first (1 - t) / (1 + t) n + 1 of the shorter. Such
pairs within the signature distance go to the exact check. A pair that no round compares is no
link, or is already known to be connected, so the components are those of all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.buffers import SpanHash, joined_hash, lowered, mixed, slices, text_bytes, words
from tideline.llm.components import components
from tideline.llm.tables import table, unused, whole_text, written

SHINGLE_WORDS = 5
SYMBOLS, CHUNK = 64, 4
DISTANCE = 2 * (SYMBOLS // CHUNK) - 1


def shingle_sets(batch: pa.RecordBatch, hashes: SpanHash, column: str) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data, offsets = text_bytes(batch.column(column))
    data = lowered(data)
    hashes.load(data)
    starts, ends, first = words(data, offsets)
    word = hashes.spans(starts, ends)
    runs = joined_hash(word, SHINGLE_WORDS)
    for low, high in zip(first[:-1], first[1:], strict=True):
        if high - low >= SHINGLE_WORDS:
            yield np.unique(runs[low: high - SHINGLE_WORDS + 1])
        elif high > low:
            yield joined_hash(word[low:high], int(high - low)) + np.uint64(high - low)
        else:
            yield np.zeros(0, np.uint64)


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n_shingles, digest of the set and signature of each row of (id, text)."""
    hashes = SpanHash()
    factors = (mixed(np.arange(SYMBOLS) + 5000) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    terms = (mixed(np.arange(SYMBOLS) + 9000) >> np.uint64(32)).astype(np.uint32)
    for batch in slices(batches, "text"):
        sets = list(shingle_sets(batch, hashes, "text"))
        sizes = np.array([len(x) for x in sets], np.int64)
        signatures = np.zeros((len(sets), SYMBOLS), np.uint16)
        full = np.flatnonzero(sizes)
        if len(full):
            flat = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
            at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            for k in range(SYMBOLS):
                least = np.minimum.reduceat(flat * factors[k] + terms[k], at)
                signatures[full, k] = (mixed(least + np.uint64(k << 32)) >> np.uint64(48)).astype(np.uint16)
        yield pa.record_batch({
            "id": batch.column("id"),
            "n_shingles": pa.array(sizes),
            "digest": pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
            "signature": pa.array([x.tobytes() for x in signatures], pa.binary()),
        })


def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (bucket, node) for each chunk of a signature and each symbol of it that may be wrong."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column("signature"))
        symbols = raw[: offsets[-1]].view(np.uint16).astype(np.uint64).reshape(-1, SYMBOLS // CHUNK, CHUNK)
        keys = []
        for wrong in range(CHUNK):
            key = np.zeros(symbols.shape[:2], np.uint64)
            for k in range(CHUNK):
                if k != wrong:
                    key = (key << np.uint64(16)) | symbols[:, :, k]
            place = np.arange(SYMBOLS // CHUNK, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(wrong)
            keys.append(mixed(mixed(key) + place))
        nodes = batch.column("node").to_numpy()
        flat = np.concatenate(keys, axis=1).reshape(-1).view(np.int64)
        yield pa.record_batch({"bucket": flat, "node": np.repeat(nodes, SYMBOLS)})


def list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (shingle, node, size) for each shingle of each row of (node, text)."""
    hashes = SpanHash()
    for batch in slices(batches, "text", 1 << 20):
        sets = list(shingle_sets(batch, hashes, "text"))
        sizes = np.array([len(x) for x in sets], np.int64)
        yield pa.record_batch({
            "shingle": np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64),
            "node": np.repeat(batch.column("node").to_numpy(), sizes), "size": np.repeat(sizes, sizes)})


def close_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of (a, b, left, right) whose signatures are within the distance."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (text_bytes(batch.column(x))[0].view(np.uint16).reshape(-1, SYMBOLS) for x in ("left", "right"))
        near = np.count_nonzero(left != right, axis=1) <= DISTANCE
        yield batch.select(["a", "b"]).filter(pa.array(near))


def pack_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = SpanHash()
    for batch in slices(batches, "text"):
        yield pa.record_batch({
            "node": batch.column("node"),
            "shingles": pa.array([x.tobytes() for x in shingle_sets(batch, hashes, "text")], pa.binary()),
        })


def confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of (a, b, left, right) whose sets are similar enough."""
    for batch in batches:
        kept = []
        for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                kept.append(False)
                continue
            merged = np.sort(np.concatenate([x, y]), kind="stable")
            common = int(np.count_nonzero(merged[1:] == merged[:-1]))
            kept.append(100 * common >= percent * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 75) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Words are runs without white space, A-Z lower-cased; a document's set holds its distinct
    five-word shingles, or its whole word sequence if it has fewer words. Documents are linked when
    intersection / union is `percent` / 100 or more. A null text is empty; without words a document
    is linked with nothing, not even another such. Documents with equal sets are one node, so
    copies form no pairs. Rows that share an id are one document, linked by each of its texts. A
    row without an id is in the component of its copies (null if they have none). An empty table gives no rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
    signed = written(texts.mapInArrow(sign, "id long, n_shingles long, digest binary, signature binary"), "signatures")
    classes = signed.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("node"), F.min("signature").alias("signature"))
    classes = written(classes.where("node is not null"), "classes")

    keyed = classes.select("node", "signature").mapInArrow(index, "bucket long, node long")
    centres = keyed.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre < last")
    members = written(keyed.join(centres.select("bucket", "centre"), "bucket"), "buckets")

    met_nodes = members.select(F.col("node").alias("id")).distinct()
    met_texts = written(texts.join(met_nodes, "id", "left_semi").withColumnRenamed("id", "node"), "bucket-texts")

    def linked(pairs: DataFrame, purpose: str) -> DataFrame:
        pairs = written(pairs.distinct(), purpose)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        packed = written(
            met_texts.join(wanted, "node", "left_semi").mapInArrow(pack_sets, "node long, shingles binary").distinct(), f"{purpose}-sets")
        return pairs.join(packed.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a").join(
            packed.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b",
        ).select("a", "b", "left", "right").mapInArrow(lambda batches: confirm(batches, percent), "a long, b long")

    first = written(
        linked(members.where("centre < node").select(F.col("centre").alias("a"), F.col("node").alias("b")), "star"), "star-links")
    found = components(first)
    placed = written(
        members.select("bucket", "node").join(found, "node", "left")
        .select("bucket", "node", F.coalesce("component", "node").alias("component")), "placed")
    unsettled = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    left_over = written(placed.join(unsettled, "bucket", "left_semi").select("node", "component").distinct(), "left-over")
    shingles = written(
        met_texts.join(left_over.select("node"), "node", "left_semi").mapInArrow(list_shingles, "shingle long, node long, size long"), "left-over-shingles")
    held = shingles.groupBy("shingle").agg(F.count("*").alias("documents")).where("documents > 1")
    rarest = Window.partitionBy("node").orderBy("documents", "shingle")
    share = percent / 100
    ranked = shingles.join(held, "shingle").withColumn("rank", F.row_number().over(rarest) + F.col("size") - F.count("*").over(Window.partitionBy("node")))
    prefixes = written(
        ranked.where(F.col("rank") <= F.floor((1 - share) * F.col("size") + 1e-6) + 1).join(left_over, "node")
        .select("shingle", "node", "component", "size", "rank", (
            F.col("rank") <= F.floor((1 - share) / (1 + share) * F.col("size") + 1e-6) + 1).alias("leads")), "prefixes")
    shorter = prefixes.where("leads").select("shingle", F.col("node").alias("a"), F.col("component").alias("p"), F.col("size").alias("m"), F.col("rank").alias("i"))
    longer = prefixes.select("shingle", F.col("node").alias("b"), F.col("component").alias("q"), F.col("size").alias("n"), F.col("rank").alias("j"))
    # The first shingle that two sets share has none before it, so what follows it bounds their intersection.
    possible = (100 + percent) * (F.least(F.col("m") - F.col("i"), F.col("n") - F.col("j")) + 1) >= percent * (F.col("m") + F.col("n"))
    met = shorter.join(longer, "shingle").where(
        (F.col("p") != F.col("q")) & (F.struct("m", "a") < F.struct("n", "b")) & (F.col("m") * 100 >= F.col("n") * percent) & possible,
    ).select("a", "b").distinct()
    signature_of = classes.groupBy("node").agg(F.min("signature").alias("signature"))
    crossing = met.join(signature_of.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a").join(
        signature_of.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b",
    ).select("a", "b", "left", "right").mapInArrow(close_signatures, "a long, b long")
    second = linked(crossing, "cross")
    reached = components(first.unionByName(second))

    member_of = classes.join(reached, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    by_row = signed.select("id", "n_shingles", "digest").join(member_of, "digest", "left")
    return by_row.select(
        F.col("id").alias(id_column), "n_shingles",
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
    )


def keep_one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The input rows of the documents that stay; a row without an id stays as it is."""
    mark = unused("_stays", docs.columns)
    stays = near_duplicates(docs, id_column, text_column).where("kept").select(F.col(id_column).alias(mark)).distinct()
    return docs.join(stays, F.col(id_column) == F.col(mark), "left").where(
        F.col(mark).isNotNull() | F.col(id_column).isNull()).drop(mark)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, CASE WHEN t = '' THEN [] ELSE string_split_regex(t, '[\x20\x09-\x0D]+') END AS ws
  FROM (SELECT doc_id, regexp_replace(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t
        FROM documents)),
s AS (
  SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(ws) < 5 THEN ws ELSE ws[i:i + 4] END, ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) k ON k.a = d.doc_id
LEFT JOIN n ON n.doc_id = d.doc_id
"""
