"""Filter semantics (F1, F2, F3, F6, F7) and global ranks without losses."""

from pyspark.sql import functions as F

from churnkit.operators import filters, ranking


def _df(spark):
    return spark.createDataFrame(
        [(1, "A", "x", 1, 1, 1), (2, "A", "y", 0, 1, 0), (3, "B", "x", 0, 0, 1), (4, "C", None, 1, 0, 0)],
        "k long, contract string, net string, senior int, contract_A int, net_x int")


def test_readable_filter_tristate_and_empty_lists(spark):
    df = _df(spark)
    ids = lambda d: sorted(r["k"] for r in d.collect())
    assert ids(filters.readable_filter(df, {"contract": [], "net": []}, "senior", "All")) == [1, 2, 3, 4]
    assert ids(filters.readable_filter(df, {"contract": ["A", "B"]}, "senior", "Senior")) == [1]
    assert ids(filters.readable_filter(df, {"contract": ["A", "B"], "net": ["x"]}, "senior", "Non-Senior")) == [3]
    assert ids(filters.focus_slice(df, "net", "y")) == [2] and ids(filters.focus_slice(df, None, None)) == [1, 2, 3, 4]


def test_onehot_filter_or_within_and_across_skips_unknown(spark):
    df = _df(spark).withColumn("contract_B", (F.col("contract") == "B").cast("int"))
    ids = lambda d: sorted(r["k"] for r in d.collect())
    out = filters.onehot_filter(df, {"contract": ["A", "B", "Nope"], "net": ["x"], "missing_dim": ["z"]})
    assert ids(out) == [1, 3]
    assert ids(filters.onehot_filter(df, {"contract": ["Nope"]})) == [1, 2, 3, 4]


def test_drill_through_and_noise(spark):
    df = _df(spark)
    cohort = spark.createDataFrame([(2,), (2,), (4,), (9,)], "k long")
    assert sorted(r["k"] for r in filters.drill_through(df, cohort, "k").collect()) == [2, 4]
    cl = spark.createDataFrame([(1, -1), (2, 0), (3, 1)], "k long, c int")
    assert sorted(r["k"] for r in filters.exclude_noise(cl, "c").collect()) == [2, 3]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "g long, v string")
    b = spark.createDataFrame([(1, 10), (None, 20)], "g long, w int")
    assert sorted(map(tuple, ranking.join_null_safe(a, b, ["g"]).collect()), key=str) == [(1, "x", 10), (None, "y", 20)]


def test_rank_keeps_every_row(spark):
    """Rows with a NULL score keep a NULL rank, NULL groups are ranked, ties share the minimum."""
    df = spark.createDataFrame([("a", 0.9), ("a", 0.9), ("a", 0.1), ("a", None), (None, 0.5), (None, 0.7)], "g string, s double")
    got = sorted(((r["g"], r["s"], r["rank"]) for r in ranking.min_rank_desc(df, "s", by=["g"]).collect()), key=str)
    assert got == sorted([("a", 0.9, 1), ("a", 0.9, 1), ("a", 0.1, 3), ("a", None, None), (None, 0.5, 2), (None, 0.7, 1)], key=str)
    assert sorted(r["rank"] or 0 for r in ranking.min_rank_desc(df, "s").collect()) == [0, 1, 1, 3, 4, 5]


def test_rank_of_many_distinct_scores(spark):
    """More distinct scores than parts; only the sums of the parts meet in one task."""
    df = spark.range(5000).select("id", (F.sin(F.col("id").cast("double"))).alias("s"))
    out = ranking.min_rank_desc(df, "s")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and "HashAggregate(keys=[_b" in plan.split("SinglePartition")[1]
    pdf = out.toPandas()
    assert (pdf["rank"] == pdf["s"].rank(method="min", ascending=False)).all()


def test_unrounded_scores(spark):
    """Scores that six places would make equal stay apart."""
    from churnkit.operators import evaluate, scoring
    df = spark.createDataFrame([(1, -16.0, 1), (2, -17.0, 0), (3, -18.0, 0)], "k long, x double, y int")
    p = df.select("k", "y", scoring.LinearScorer("m", 0.0, {"x": 1.0}).prob().alias("p"))
    assert evaluate.roc_auc(p, "p", "y").first()["auc"] == 1.0
    assert len({r["p"] for r in p.collect()}) == 3
    points = evaluate.pr_curve(p, "p", "y", 0.5).collect()
    assert [(r["precision"], r["recall"]) for r in points if r["score"] is not None] == [(1.0, 1.0)]


def test_every_rank_is_checked(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") < 5990, F.floor(F.col("id") / 2).cast("double")).alias("s"))
    ranked = ranking.min_rank_desc(df, "s")
    checked = lambda x: tuple(ranking.rank_violations(x, "s").first())
    assert checked(ranked) == (6000, 0) and checked(ranked.limit(0)) == (0, 0)
    for low in (F.col("rank") + 1, F.col("rank") - 2, F.lit(None)):
        n, bad = checked(ranked.withColumn("rank", F.when(F.col("s") == 7.0, low).otherwise(F.col("rank"))))
        assert n == 6000 and bad >= 2
