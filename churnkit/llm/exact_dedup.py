"""Exact deduplication by a tree merge of digest runs (DataFrame functions only).

The rows are split over ``runs`` starting runs.  A run holds one entry per
distinct digest: the row that would stay, and how many rows it stands for.  In
each binomial round run ``r`` and its partners (the runs that differ in the
lowest ``log2(fan_in)`` bits still open) exchange entries and merge them, so the
winner of a digest is decided level by level and no task ever meets more than
``fan_in`` entries of one digest, however many copies it has.  The rounds are
then walked down again: a run learns the final winner from the run it was merged
into, and the rows learn it from their starting run.

Entries are equal when SHA-256, a second 64-bit hash and the length of the
normalised text agree; these are checked at every level because they are the
merge key.

Defined cases: null text counts as empty; equal texts with equal length keep the
smallest doc_id; null doc_ids come after all others; rows repeated with the same
doc_id and text are all marked with the same ``keep_id`` and each is ``kept`` if
its doc_id is the winner's; an empty table gives an empty result; other columns
of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import WHITE, stored

_KEY = ["sha", "check", "norm_len"]


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_code_points and the digest key of every row."""
    norm = F.translate(F.coalesce(F.col("text"), F.lit("")), WHITE, "")
    return docs.select(
        F.col("doc_id"), F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("size"), norm.alias("norm"),
    ).select("doc_id", "size", F.unhex(F.sha2(F.col("norm"), 256)).alias("sha"),
             F.xxhash64("norm").alias("check"), F.octet_length("norm").alias("norm_len"))


def tree_merge(spark: SparkSession, rows: DataFrame, *, runs: int = 64, fan_in: int = 8) -> DataFrame:
    """rows: doc_id, size and the digest key.  Adds keep_id and group_size to each row."""
    if runs < 1 or fan_in < 2 or fan_in & (fan_in - 1):
        raise ValueError("runs must be positive and fan_in a power of two above 1")
    bits = fan_in.bit_length() - 1
    # The run depends on the row alone, so a recomputed task deals the same rows.
    rows = rows.withColumn("run", F.pmod(F.xxhash64("doc_id", "size"), F.lit(runs)).cast("int"))
    best = F.struct((-F.col("size")).alias("neg_size"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))
    level = rows.groupBy("run", *_KEY).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
    levels = [stored(spark, level, "exact-run")]
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        level = (levels[-1].select(F.shiftright("run", bits).alias("run"), *_KEY, "best", "n")
                 .groupBy("run", *_KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n")))
        levels.append(stored(spark, level, "exact-run") if left > 1 else level)
    final = levels.pop().select("run", *_KEY, F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"))
    while levels:
        below = levels.pop().select("run", F.shiftright("run", bits).alias("into"), *_KEY)
        above = final.withColumnRenamed("run", "into")
        final = below.join(above, ["into", *_KEY]).select("run", *_KEY, "keep_id", "group_size")
    return rows.join(final, ["run", *_KEY]).drop("run")


def exact_dedup(spark: SparkSession, docs: DataFrame, *, runs: int = 64, fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``."""
    rows = stored(spark, digests(docs), "exact-digests")
    merged = tree_merge(spark, rows, runs=runs, fan_in=fan_in)
    return merged.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that an equal text replaces.

    A winner that is in the table several times (same doc_id, same text) stays once.
    """
    winners = stored(spark, exact_dedup(spark, docs, **options).where("kept").groupBy("doc_id", "text_sha256").count(),
                     "exact-winners")
    norm = F.translate(F.coalesce(F.col("text"), F.lit("")), WHITE, "")
    w = winners.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("count").alias("__n"))
    on = (F.sha2(norm, 256) == w["__sha"]) & docs["doc_id"].eqNullSafe(w["__id"])
    if winners.where("count > 1").limit(1).count() == 0:
        return docs.join(w, on, "left_semi")
    once = docs.join(w.where("__n = 1"), on, "left_semi")
    return once.unionByName(docs.join(w.where("__n > 1"), on, "left_semi").dropDuplicates(["doc_id", "text"]))


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, first(doc_id ORDER BY size DESC, doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
"""
