"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tideline.llm.buffers import slices
from tideline.llm.tables import fold_of, table, whole_text, written

PROFILE_GRAMS = 400
UNKNOWN = "und"
GAP = 1  # code of what lies between words; letters follow from 2 on


def letter_codes() -> np.ndarray:
    """For each code point, itself plus 2 if it is a letter or a mark, else GAP."""
    import unicodedata

    kinds = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])
    return np.where(kinds, np.arange(0x110000) + 2, GAP)


def grams_of(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All 1-, 2- and 3-grams of the words of all texts, and the text each belongs to.

    Words are runs of letters, lower-cased, with a gap on both sides. A gram is a number of up to
    three codes of 21 bits.
    """
    points = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
    edge = np.full(1, 32, np.uint32)
    flat = codes[np.concatenate([edge, *(x for p in points for x in (p, edge))])]
    owner = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in points])
    owner = np.append(owner[:1], owner) if len(owner) else owner
    solid = flat != GAP
    stays = solid | np.append(True, solid[:-1])
    flat, owner, solid = flat[stays], owner[stays], solid[stays]
    one = np.flatnonzero(solid)
    two = np.flatnonzero(solid[:-1] | solid[1:]) if len(flat) else one
    three = np.flatnonzero(solid[1:-1]) if len(flat) > 2 else one[:0]
    grams = np.concatenate([
        flat[one],
        flat[two] << 21 | flat[two + 1],
        flat[three] << 42 | flat[three + 1] << 21 | flat[three + 2],
    ])
    # A gram belongs to the text of its last letter; the gap before a text's first word has the owner of the text before.
    whose = np.concatenate([owner[one], np.where(solid[two + 1], owner[two + 1], owner[two]), owner[three + 1]])
    return grams, whose


def ranked(grams: np.ndarray, most: int) -> np.ndarray:
    """The most frequent grams, in order; equal counts by code."""
    found, counts = np.unique(grams, return_counts=True)
    if len(found) > most:
        floor = np.partition(counts, len(counts) - most)[len(counts) - most]
        found, counts = found[counts >= floor], counts[counts >= floor]
    return found[np.lexsort((found, -counts))][:most]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, count of a slice of (lang, text)."""
    codes = letter_codes()
    for batch in slices(batches, "text", 1 << 20):
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = np.array(batch.column("text").to_pylist(), object)
        for lang in sorted(set(langs)):
            grams, _ = grams_of(list(texts[langs == lang]), codes)
            found, counts = np.unique(grams, return_counts=True)
            yield pa.record_batch({"lang": pa.array([lang] * len(found), pa.string()), "gram": found.astype(np.int64), "count": counts.astype(np.int64)})


def learn_profiles(labelled: DataFrame, most: int = PROFILE_GRAMS) -> DataFrame:
    """lang, gram, rank: the most frequent grams of all texts of each language, from (lang, text)."""
    counts = labelled.mapInArrow(count_grams, "lang string, gram long, count long").groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("lang", "gram", "rank")


def judge(names: list[str], profiles: list[np.ndarray], most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Out-of-place distance of each text's ranking to each profile; the least wins, then the first name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = letter_codes()
        sorted_grams = np.unique(np.concatenate(profiles)) if profiles else np.zeros(0, np.int64)
        place = np.full((len(names), len(sorted_grams) + 1), -1, np.int64)
        for k, grams in enumerate(profiles):
            place[k, np.searchsorted(sorted_grams, grams)] = np.arange(len(grams))
        for batch in slices(batches, "text", 1 << 20):
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            grams, whose = grams_of(texts, codes)
            order = np.argsort(whose, kind="stable")
            grams = grams[order]
            cuts = np.searchsorted(whose[order], np.arange(len(texts) + 1))
            chosen, scores = [], []
            for text, low, high in zip(texts, cuts[:-1], cuts[1:], strict=True):
                # Marks count in words, but a text of marks alone has no letter.
                if low == high or not names or not any(map(str.isalpha, text)):
                    chosen.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = ranked(grams[low:high], most)
                at = np.searchsorted(sorted_grams, own)
                known = sorted_grams[np.minimum(at, len(sorted_grams) - 1)] == own
                there = np.where(known, place[:, np.minimum(at, len(sorted_grams) - 1)], -1)
                away = np.where(there < 0, most, np.abs(there - np.arange(len(own))))
                distance = away.sum(axis=1)
                best = int(np.argmin(distance))
                chosen.append(names[best])
                scores.append(1.0 - float(distance[best]) / (most * len(own)))
            yield pa.record_batch({"id": batch.column("id"), "lang_pred": pa.array(chosen, pa.string()), "score": pa.array(scores, pa.float64())})

    return run


def judge_by(learned: DataFrame, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """judge() with the profiles of learn_profiles()."""
    profiles: dict[str, list[int]] = {}
    for row in sorted(learned.collect(), key=lambda r: (r.lang, r["rank"])):
        profiles.setdefault(row.lang, []).append(row.gram)
    names = sorted(profiles)
    return judge(names, [np.array(profiles[n], np.int64) for n in names], most)


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    folds: int = 4, held: int = 2, most: int = PROFILE_GRAMS,
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    Profiles are learned from the texts with a language whose id is not in the held fold; the
    prediction looks at the text only. `score` is 1 minus the mean displacement over the greatest
    one: 0 for a text that shares no gram with its nearest profile. A text that is null or has no
    letter is `und` with score 0, and so is every text if there is nothing to learn from.
    `most` grams of each language are sent to the tasks, whatever the size of the input. A null
    id is in fold 0. Rows are judged one by one: repeated rows get equal results, other columns are ignored.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"),
        (fold_of(id_column, folds) == held).alias("held_out"))
    learned = learn_profiles(rows.where("not held_out and lang is not null and text is not null").select("lang", "text"), most)
    id_type = docs.schema[id_column].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(
        judge_by(learned, most), f"id {id_type}, lang_pred string, score double",
    ).select(F.col("id").alias(id_column), (fold_of("id", folds) == held).alias("held_out"), "lang_pred", "score")


def keep_known_languages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    folds: int = 4, held: int = 2, most: int = PROFILE_GRAMS,
) -> DataFrame:
    """The input rows without those that are `und` or further from their language than all labelled texts of it.

    Rows are judged one by one, those without an id too. The bound is the least score among all texts
    with a language that are judged to be in the same one and have as many characters, to a factor of
    two; where there are none, the least score of that language. So no labelled text with letters goes.
    """
    rows = docs.select(F.struct(*docs.columns).alias("id"), F.col(text_column).alias("text"))
    labelled = docs.select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"), (fold_of(id_column, folds) == held).alias("held_out")
    ).where("not held_out and lang is not null and text is not null")
    schema = StructType([StructField("id", rows.schema["id"].dataType), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    judged = written(rows.mapInArrow(judge_by(learn_profiles(labelled.select("lang", "text"), most), most), schema), "judged-rows")
    judged = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).withColumn(
        "band", F.floor(F.log2(F.length(F.col("id")[text_column]))).cast("int"))
    known = judged.where(F.col("id")[lang_column].isNotNull())
    by_band = known.groupBy("lang_pred", "band").agg(F.min("score").alias("least_here"))
    by_lang = known.groupBy("lang_pred").agg(F.min("score").alias("least"))
    near = judged.join(F.broadcast(by_band), ["lang_pred", "band"], "left").join(F.broadcast(by_lang), "lang_pred", "left")
    return near.where(F.col("score") >= F.coalesce("least_here", "least", F.lit(0.0))).select("id.*")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
