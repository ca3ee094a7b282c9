"""A training-data pipeline: language, near-duplicates, benchmark leaks, personal data, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textweir.llm.common import Scratch, table
from textweir.llm.decontaminate import without_leaks
from textweir.llm.jaccard import one_of_each
from textweir.llm.language import in_known_language, train
from textweir.llm.mixing import mix
from textweir.llm.pii import redact
from textweir.shipping import ship

#: Documents whose best language scores below this are rejected.
MIN_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned; null texts, texts without letters and texts unlike all languages go. Each row counts for itself, repeated ids too; no documents give none."""
    ship(spark)
    return in_known_language(docs, train(docs), MIN_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of texts whose sets of five-word shingles have a similarity of 0.8 or more.

    Of rows that repeat an id one stays; rows without an id stay; no documents give none.
    """
    ship(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item; null and empty texts hold none, an empty benchmark drops nothing."""
    ship(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; null and empty texts stay as they are, and every row is kept."""
    ship(spark)
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give every document its place in the mixture of the sources; a null source is one of its own, rows alike each get a place, and no documents give none."""
    ship(spark)
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Kernels, alignment and bootstrapping can't be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
