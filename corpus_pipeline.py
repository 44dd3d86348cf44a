"""Corpus pipeline: the documents a training run would read, packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table that is stored as
Parquet before the next stage reads it. The first three drop documents and keep the
columns of ``documents``; the last returns the pieces of all documents that are left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqtide.llm import exact_dedup, jaccard_join, packing, quality_rules
from seqtide.llm.queries import WORD_VOCABULARY, documents
from seqtide.session import scratch, scratch_path

#: Words whose ids the packing stage's workers remember: the workers serve other stages too.
REMEMBERED = 400_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality_rules.kept(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.kept(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that links of similarity 0.8 connect."""
    return jaccard_join.kept(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048 ids or a smaller power of two."""
    return packing.pack(docs, WORD_VOCABULARY, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("packing", pack)]

#: Token ids are beyond SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch(spark):  # what the stage stored on its way goes once its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
