"""Corpus preparation over the ``documents`` table, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnkit.llm import decontamination, exact_dedup, jaccard_join, langid, packing
from churnkit.llm.common import stored
from churnkit.llm.queries import table, tokenizer_path
from churnkit.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go (no letters, or no dominant language)."""
    ship_package(spark)
    return langid.keep_identified(spark, docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    ship_package(spark)
    return exact_dedup.drop_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    ship_package(spark)
    return jaccard_join.one_of_each(spark, docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontamination.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    ship_package(spark)
    return packing.packed_digests(spark, docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No SQL for the language model, the similarity join or the tokenizer; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
