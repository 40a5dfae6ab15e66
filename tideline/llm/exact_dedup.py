"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import WHITE
from tideline.llm.tables import table, unused, whole_text, written

PREFIX_POINTS = 64


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    prefix_points: int = PREFIX_POINTS, digest_all: bool = False,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after deleting white space; a null text counts as empty. Of
    equal texts the one with the most code points stays, then the one with the smallest id (null
    last). Rows that repeat both id and text share their result, so each is marked as kept.

    A row goes to the next, dearer key only if it shares the one before: length, hash of a
    prefix, hash of the whole. `digest_all=False` hashes whole texts of these survivors only and
    leaves `text_sha256` null elsewhere; True hashes all, so that no text has to be shuffled.
    Other columns are ignored. An empty table gives no rows.
    """
    squeezed = F.translate(whole_text(text_column), WHITE, "")
    digest = F.sha2(F.col("squeezed").cast("binary"), 256)
    keyed = docs.select(
        F.col(id_column).alias("id"), F.length(whole_text(text_column)).cast("long").alias("points"), squeezed.alias("squeezed"),
    ).select(
        "id", "points", F.length("squeezed").alias("size"),
        F.xxhash64(F.substring("squeezed", 1, prefix_points)).alias("prefix"),
        digest.alias("sha") if digest_all else F.col("squeezed"),
    )
    if digest_all:
        keyed = written(keyed, "exact-fingerprints")
    sizes = keyed.groupBy("size").count().where("count > 1").select("size")
    prefixes = (
        keyed.select("size", "prefix").join(sizes, "size", "left_semi")
        .groupBy("size", "prefix").count().where("count > 1").select("size", "prefix", F.lit(True).alias("shared"))
    )
    rows = keyed.join(prefixes, ["size", "prefix"], "left")
    if not digest_all:
        rows = written(rows.withColumn("sha", F.when(F.col("shared"), digest)).drop("squeezed"), "exact-survivors")
    groups = (
        rows.where("shared").groupBy("size", "prefix", "sha")
        .agg(F.count("*").alias("copies"), F.min(F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("u"), "id")).alias("best"))
        .where("copies > 1")
        .select("size", "prefix", "sha", "copies", F.col("best.id").alias("keep"), (-F.col("best.p")).alias("most"))
    )
    return rows.join(groups, ["size", "prefix", "sha"], "left").select(
        F.col("id").alias(id_column),
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (F.col("copies").isNull() | (F.col("id").eqNullSafe(F.col("keep")) & (F.col("points") == F.col("most")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The input rows that stay, with their own columns; a row without an id stays as it is.

    Rows that repeat one id are one document: such a row stays if a row of its id does.
    """
    mark = unused("_stays", docs.columns)
    stays = (
        exact_duplicates(docs, id_column, text_column, digest_all=True)
        .where(F.col("kept") & F.col(id_column).isNotNull()).select(F.col(id_column).alias(mark)).distinct()
    )
    return docs.join(stays, F.col(id_column) == F.col(mark), "left").where(
        F.col(mark).isNotNull() | F.col(id_column).isNull()
    ).drop(mark)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(s) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY s ORDER BY length(t) DESC, doc_id)
"""
