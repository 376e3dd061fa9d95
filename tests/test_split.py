"""Splits: exact sizes, disjoint, stratified, independent of partitioning."""

from pyspark.sql import functions as F

from churnkit.operators import split
from churnkit.sources import adapters

from paths import SF_MID


def test_split_sizes_exact_and_disjoint(spark):
    raw = adapters.raw_customers(spark, SF_MID).select("customer_id", "churn")
    s = split.stratified_split(raw, "churn", "customer_id").persist()
    assert s.count() == raw.count() == s.select("customer_id").distinct().count()
    by = {(r["churn"], r["split"]): r["count"] for r in s.groupBy("churn", "split").count().collect()}
    for lab in ("Yes", "No"):
        n = sum(v for (c, _), v in by.items() if c == lab)
        assert by[(lab, "test")] == int(0.2 * n + 0.5)
        assert by[(lab, "val")] == int(0.2 * n + 0.5)
    folds = s.where("split = 'train'").groupBy("churn", "fold").count().collect()
    for lab in ("Yes", "No"):
        c = [r["count"] for r in folds if r["churn"] == lab]
        assert len(c) == 5 and max(c) - min(c) <= 1


def test_split_is_partitioning_invariant(spark):
    raw = adapters.raw_customers(spark, SF_MID).select("customer_id", "churn")
    a = split.stratified_split(raw, "churn", "customer_id", prefix_hex=2)
    b = split.stratified_split(raw.repartition(13), "churn", "customer_id", prefix_hex=4)
    key = lambda df: sorted((r["customer_id"], r["split"], r["fold"]) for r in df.collect())
    assert key(a) == key(b)


def test_balanced_and_pos_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(8)], "k long, y int")
    w = {r["y"]: r["weight"] for r in split.balanced_weights(df, "y").select("y", "weight").distinct().collect()}
    assert w == {1: 8 / (2 * 2), 0: 8 / (2 * 6)}
    assert split.pos_weight_ratio(df, "y") == 3.0
    assert split.pos_weight_ratio(df.where(F.col("y") == 0), "y") == 6.0  # max(1, n_pos)
