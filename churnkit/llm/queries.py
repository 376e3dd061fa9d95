"""Registered queries of this subpackage: name -> (query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnkit.llm import (conversation_repair, decontamination, exact_dedup, jaccard_join, langid, license_scan, packing, quality,
                          ranked_search, sharding, style_tree, substring_dedup, warc)
from churnkit.session import ship_package

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_warc_segments")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archives back, describe each record."""
    return warc.archive_pages(spark, table(spark, sf_dir, "pages")).drop("url")


@query("op2_heavy_light_jaccard")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 4-word-shingle Jaccard similarity of 0.85."""
    return jaccard_join.jaccard_components(spark, table(spark, sf_dir, "documents"))


@query("op3_template_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that any document contains, verbatim or re-parameterised."""
    return decontamination.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tkey")


@query("op4_site_style_tree")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return style_tree.extract(spark, table(spark, sf_dir, "pages"))


@query("op5_tree_merge_dedup", exact_dedup.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents by a tree merge of digest runs."""
    return exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))


@query("op6_subword_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned from labelled documents that are not held out."""
    return quality.score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_hilbert_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into 4096-token sequences along a Hilbert curve."""
    return packing.packed_digests(spark, table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_hypergeometric_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 24 shards of exact size."""
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"))


@query("op9_seed_extend")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words and more removed from all documents."""
    return substring_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))


@query("op10_language_mixture")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by mixture inference, learned from those not held out."""
    return langid.label_languages(spark, table(spark, sf_dir, "documents"))


@query("op11_nra_search", ranked_search.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every benchmark item."""
    return ranked_search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("op12_lightest_repair", conversation_repair.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged as their turns' hashes say, and repaired at the least cost."""
    return conversation_repair.report(spark, table(spark, sf_dir, "conversations"))


@query("op13_license_templates", license_scan.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and licence templates in all documents."""
    return license_scan.report(spark, table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
