"""Token counts with a digest cache: stored counts are joined, only distinct new texts are encoded."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import slices
from tideline.llm.chunks import Numbered, cut, ids_of, json_cuts_at_spaces, json_tokenizer
from tideline.llm.tables import table, whole_text, written
from tideline.session import shared_dir

STORED = "content binary, n_tokens long"
LIMIT = 1024
# A digest takes 32 bytes: up to 1.6 MB of them are sent to all tasks, more meet the texts in a shuffle.
BROADCAST_MISSES = 50_000


def tokenizer_digest(path: str, content: bytes) -> str:
    """Names a tokenizer's version: library, its release, and the bytes of the file."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    head = f"{library.__name__} {library.__version__}\n".encode()
    return hashlib.sha256(head + content).hexdigest()


def counter(path: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """Counts of tokens of whole texts, as the library of the file gives them, without special tokens.

    Byte-level tokens are counted by chunks, each distinct one encoded once. A text that holds the
    string of an added token goes to the library whole, and so does every text of other tokenizers.
    """
    if not path.endswith(".json"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: list(map(len, processor.encode(texts, num_threads=1)))
    tokenizer = json_tokenizer(content)

    def whole(texts: list[str]) -> list[int]:
        return list(map(len, ids_of(tokenizer, texts)))

    if not json_cuts_at_spaces(content):
        return whole
    added = [x["content"] for x in json.loads(content).get("added_tokens") or []]
    numbered, sizes = Numbered(), []

    def by_chunks(texts: list[str]) -> list[int]:
        odd = [any(a in t for a in added) for t in texts]
        chunks = [[] if o else cut(t) for t, o in zip(texts, odd, strict=True)]
        if numbered.full():
            numbered.clear()
            sizes.clear()
        sizes.extend(whole(numbered.add(chunks)))
        number = numbered.number
        counts = [sum([sizes[number[c]] for c in x]) for x in chunks]
        for at in np.flatnonzero(odd).tolist():
            counts[at] = whole([texts[at]])[0]
        return counts

    return by_chunks


def normal_form(path: str, content: bytes) -> Callable[[str], str] | None:
    """What the tokenizer makes of a text before it splits it; None where that is the text itself.

    Strings of added tokens are cut out before a text is normalised: a text with one, before or
    after, stands for itself.
    """
    if not path.endswith(".json") or json.loads(content).get("normalizer") is None:
        return None
    normalizer = json_tokenizer(content).normalizer
    added = [x["content"] for x in json.loads(content).get("added_tokens") or []]

    def normal(text: str) -> str:
        form = normalizer.normalize_str(text)
        # The mark keeps a text that stands for itself apart from the normal form of another.
        return "\x00" + text if any(a in text or a in form for a in added) else "\x01" + form

    return normal


def content_digest(text_column: str, path: str, content: bytes) -> Column:
    """The digest of each text's normal form."""
    text = whole_text(text_column)
    if normal_form(path, content) is not None:
        @F.pandas_udf("string")
        def normalised(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            form = normal_form(path, content)
            for batch in texts:
                yield batch.map(form)

        text = normalised(text)
    return F.unhex(F.sha2(text.cast("binary"), 256))


def stored_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts of one tokenizer version, one row per content; none if nothing is stored yet."""
    try:
        stored = spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)
    # Runs side by side may have stored one content twice, with the same count.
    return stored.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def encode_misses(path: str, content: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, content)
        for batch in slices(batches, "text"):
            yield pa.record_batch({
                "content": batch.column("content").cast(pa.binary()),
                "n_tokens": pa.array(count(pc.fill_null(batch.column("text"), "").to_pylist()), pa.int64()),
            })

    return run


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache: str, id_column: str = "doc_id", text_column: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit; `cache` is a folder all executors share.

    Rows carry the SHA-256 of their text in the tokenizer's normal form. Digests that the cache holds
    for this tokenizer version (library, release, bytes of the file) take the stored count; of the
    others each distinct text is encoded once and its count appended. Another version has a folder of
    its own, so stored counts never go stale. A run appends to a subfolder of its own: a run that
    breaks off leaves nothing that is read, and runs side by side store at worst equal counts twice.

    Texts are shuffled only where they are missing from the cache, one copy for each task that holds
    any, so a text that many rows share is not gathered. Null and empty texts have no tokens. Repeated
    rows and rows without an id each keep their row; other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer_path, content)}"
    digest = content_digest(text_column, tokenizer_path, content)
    keyed = written(docs.select(
        F.col(id_column), F.octet_length(whole_text(text_column)).cast("long").alias("n_bytes"), digest.alias("content"),
    ).toDF("id", "n_bytes", "content"), "token-digests")
    misses = written(
        keyed.select("content").distinct().join(stored_counts(spark, folder), "content", "left_anti"), "token-misses")
    missing = misses.count()
    if missing:
        texts = docs.select(digest.alias("content"), whole_text(text_column).alias("text"))
        if missing <= BROADCAST_MISSES:
            texts = texts.join(F.broadcast(misses), "content", "left_semi").dropDuplicates(["content"])
        else:
            texts = texts.dropDuplicates(["content"]).join(misses, "content", "left_semi")
        texts.mapInArrow(encode_misses(tokenizer_path, content), STORED).write.parquet(f"{folder}/run-{uuid.uuid4().hex}")
    # Written, so that nothing but the join meets the rows of one content: a common one can be split.
    counts = written(stored_counts(spark, folder), "token-counts")
    return keyed.join(counts, "content", "left").select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
    )


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of `documents`; the cache is the folder `spark.tideline.token.cache` names, else a new one."""
    import public_tokenizers

    cache = spark.conf.get("spark.tideline.token.cache", None) or shared_dir(spark, "token-cache")
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)
