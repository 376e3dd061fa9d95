"""Global ranks, running counts and top-k without a single-partition pass
(W1, W2, W7, W8).

Scores are grouped to their distinct values first (partial aggregation, so a
value shared by a third of all rows costs one row per map task).  Running sums
over the distinct values are range-partitioned: quantiles of the values cut them
into buckets, each bucket is summed on its own, and the sums of the buckets
before it (a table of ``BUCKETS`` rows per group) are added.  So any number of
distinct scores works, rounded or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.session import stored

#: Parts that a running sum over distinct scores is cut into.
BUCKETS = 256


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join in which NULL keys match NULL keys; the key columns of ``left`` stay."""
    if not on:
        return left.crossJoin(right)  # one row on the right
    renamed = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns])
    cond = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return left.join(renamed, cond, how).drop(*[f"_on_{c}" for c in on])


def running_sums(counts: DataFrame, score: str, cols: list[str], by: list[str], descending: bool, inclusive: bool) -> DataFrame:
    """``counts`` (one row per ``by`` and distinct ``score``) with ``cum_<col>`` in score order inside each group."""
    counts = stored(counts.sparkSession, counts, "scores")
    cuts = counts.agg(F.percentile_approx(score, [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    upto = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col(score))) if cuts else F.lit(0)
    bucket = (-upto if descending else upto).cast("int")
    counts = counts.withColumn("_b", bucket)
    key = F.col(score).desc() if descending else F.col(score).asc()
    local = Window.partitionBy(*by, "_b").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows at most
    offsets = counts.groupBy(*by, "_b").agg(*[F.sum(c).alias(c) for c in cols]).select(
        *by, "_b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in cols])
    out = counts.withColumns({f"cum_{c}": F.coalesce(F.sum(c).over(local), F.lit(0)) for c in cols})
    out = join_null_safe(out, offsets, [*by, "_b"])
    return out.withColumns({f"cum_{c}": (F.col(f"cum_{c}") + F.col(f"_off_{c}")).cast("long") for c in cols}).drop(
        "_b", *[f"_off_{c}" for c in cols])


def min_rank_desc(df: DataFrame, score: str, out: str = "rank", by: list[str] | None = None) -> DataFrame:
    """Rank by descending score, ties share the minimum rank
    (``rank(method='min', ascending=False)``): rank = 1 + #rows with a higher score.
    A row with a NULL score keeps a NULL rank; NULL groups are a group."""
    by = by or []
    hist = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_sums(hist, score, ["_n"], by, descending=True, inclusive=False).select(
        *by, score, (F.col("cum__n") + 1).cast("long").alias(out))
    return join_null_safe(df, ranks, [*by, score], "left")


def rank_violations(ranked: DataFrame, score: str, rank: str = "rank") -> DataFrame:
    """One row (n_rows, violations) over all rows of a ranked table, by joins of its distinct ranks.

    The highest score has rank 1; any other rank has one score, and the score whose rows end before it is higher.
    NULL scores have NULL ranks.
    """
    groups = stored(ranked.sparkSession, ranked.groupBy(F.col(score).alias("_s"), F.col(rank).cast("long").alias("_r"))
                    .agg(F.count(F.lit(1)).alias("_n")), "ranks")
    top = groups.agg(F.max("_s")).first()[0]
    by_rank = groups.where("_s IS NOT NULL").groupBy(F.col("_r").alias("_at")).agg(F.count(F.lit(1)).alias("_scores"))
    ends = groups.where("_s IS NOT NULL").groupBy((F.col("_r") + F.col("_n")).alias("_end")).agg(
        F.count(F.lit(1)).alias("_before"), F.min("_s").alias("_higher"))
    joined = groups.join(by_rank, groups["_r"] == by_rank["_at"], "left").join(ends, groups["_r"] == ends["_end"], "left")
    right = (F.col("_scores") == 1) & F.when(F.col("_r") == 1, F.col("_s") == F.lit(top)).otherwise(
        (F.col("_before") == 1) & (F.col("_higher") > F.col("_s")))
    right = F.when(F.col("_s").isNull(), F.col("_r").isNull()).otherwise(F.coalesce(right, F.lit(False)))
    return joined.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                      F.coalesce(F.sum(F.when(~right, F.col("_n"))), F.lit(0)).alias("violations"))


def top_k(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The k highest scores, ties broken by key (TakeOrderedAndProject:
    each task keeps k rows, the driver merges k x tasks)."""
    return df.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)


def first_max(df: DataFrame, metric: str, candidate: str, by: list[str] | None = None) -> DataFrame:
    """Argmax of ``metric`` over candidates, the smallest candidate wins ties."""
    by = by or []
    if not by:
        return df.orderBy(F.col(metric).desc(), F.col(candidate).asc()).limit(1)
    w = Window.partitionBy(*by).orderBy(F.col(metric).desc(), F.col(candidate).asc())
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def running_counts_desc(counts: DataFrame, score: str, cols: list[str], by: list[str] | None = None,
                        inclusive: bool = True) -> DataFrame:
    """Cumulative sums of ``cols`` over descending distinct scores."""
    return running_sums(counts, score, cols, list(by or []), descending=True, inclusive=inclusive)
