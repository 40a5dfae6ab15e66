"""A corpus made ready for training: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.decontaminate import keep_uncontaminated
from tideline.llm.exact_dedup import keep_first_copies
from tideline.llm.language import keep_known_languages
from tideline.llm.near_dedup import keep_one_of_each_group
from tideline.llm.pieces import default_model, encode_texts, token_digests
from tideline.llm.tables import table
from tideline.session import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no known language; profiles are learned from these documents."""
    return keep_known_languages(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_first_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; those without words stay."""
    return keep_one_of_each_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark."""
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the decoded text."""
    return token_digests(encode_texts(docs, default_model()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

# Latent search, MinHash and merges of pieces have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
