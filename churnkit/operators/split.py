"""Exact, repeatable stratified splits, CV folds and class weights (M1-M4).

Order inside each class is ``md5(key | seed)`` (then key) — identical in any
SQL engine, no ``rand()``.  The rank of a row inside its class is computed
without a per-class window over the whole class (a label value holds half
the table): rows are bucketed by a hash prefix, bucket counts (bounded by
the number of buckets) give each bucket its offset, and only the rows of
one bucket are sorted together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.operators.ranking import join_null_safe


def hash_order(key: str, seed: int | str) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_rank(df: DataFrame, label: str, key: str, seed: int = 42, prefix_hex: int = 5,
                    out: str = "class_rank") -> DataFrame:
    """1-based rank of each row inside its label class by (md5(key|seed), key),
    plus the class size ``class_n``."""
    h = hash_order(key, seed)
    d = df.withColumns({"_h": h, "_hb": F.conv(F.substring(h, 1, prefix_hex), 16, 10).cast("int")})
    counts = d.groupBy(label, "_hb").agg(F.count(F.lit(1)).alias("_bn"))
    wc = Window.partitionBy(label).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(label)
    offsets = counts.select(label, "_hb", F.coalesce(F.sum("_bn").over(wc), F.lit(0)).alias("_off"),
                            F.sum("_bn").over(wt).alias("class_n"))
    local = Window.partitionBy(label, "_hb").orderBy("_h", key)
    ranked = join_null_safe(d, offsets, [label, "_hb"])  # rows without a label are a class of their own
    return ranked.withColumn(out, (F.col("_off") + F.row_number().over(local)).cast("long")).drop("_h", "_hb", "_off")


def _take(frac: float, n) -> F.Column:
    return F.floor(F.lit(frac) * n + F.lit(0.5)).cast("long")


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2, val: float = 0.2, seed: int = 42,
                     folds: int = 5, prefix_hex: int = 5) -> DataFrame:
    """M1 + M2: 'test' / 'val' / 'train' with exact per-class counts
    (floor(frac * n_class + 0.5)), and a round-robin CV fold on train rows."""
    r = stratified_rank(df, label, key, seed, prefix_hex)
    n_test = _take(test, F.col("class_n"))
    n_val = _take(val, F.col("class_n"))
    split = (F.when(F.col("class_rank") <= n_test, "test")
             .when(F.col("class_rank") <= n_test + n_val, "val").otherwise("train"))
    fold = F.when(split == "train", ((F.col("class_rank") - n_test - n_val - 1) % folds).cast("int"))
    return r.withColumns({"split": split, "fold": fold}).drop("class_rank", "class_n")


def class_counts(df: DataFrame, label: str) -> dict:
    """Label value -> count (one row per class reaches the driver)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M3: weight n / (k * n_c) per row (sklearn 'balanced')."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    m = F.create_map(*[x for c, v in counts.items() for x in (F.lit(c), F.lit(n / (k * v)))])
    return df.withColumn(out, m[F.col(label)])


def pos_weight_ratio(df: DataFrame, label: str, positive=1) -> float:
    """M4: n_neg / max(1, n_pos) of the given (fit) subset."""
    counts = class_counts(df, label)
    pos = counts.get(positive, 0)
    return (sum(counts.values()) - pos) / max(1, pos)


def pos_weights(df: DataFrame, label: str, positive=1, out: str = "weight") -> DataFrame:
    """M4: weight 1 for negatives, n_neg / max(1, n_pos) for positives."""
    r = pos_weight_ratio(df, label, positive)
    return df.withColumn(out, F.when(F.col(label) == positive, F.lit(r)).otherwise(F.lit(1.0)))
