"""Evaluation operators against brute force on small fixtures, plus properties."""

import itertools
import random

from pyspark.sql import functions as F

from churnkit.operators import evaluate, ranking


def _fixture(spark, n=300, seed=7, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.3 else 0
        p = round(min(1.0, max(0.0, rnd.gauss(0.35 + 0.3 * y, 0.2))), 2 if ties else 6)
        rows.append((i, y, p))
    return rows, spark.createDataFrame(rows, "k long, y int, p double")


def _auc_brute(rows):
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_auc_matches_pairwise_and_symmetry(spark):
    rows, df = _fixture(spark)
    auc = evaluate.roc_auc(df, "p", "y").first()["auc"]
    assert abs(auc - _auc_brute(rows)) < 1e-12
    flipped = evaluate.roc_auc(df.withColumn("p", -F.col("p")), "p", "y").first()["auc"]
    assert abs(auc + flipped - 1.0) < 1e-12


def test_threshold_sweep_matches_brute_force(spark):
    rows, df = _fixture(spark, ties=False)
    sweep = {r["i"]: r for r in evaluate.threshold_sweep(df, "p", "y").collect()}
    assert len(sweep) == 201
    P = sum(y for _, y, _ in rows)
    for i in (0, 1, 37, 60, 100, 150, 199, 200):
        t = i / 200.0
        tp = sum(1 for _, y, p in rows if p >= t and y == 1)
        fp = sum(1 for _, y, p in rows if p >= t and y == 0)
        fn = P - tp
        assert (sweep[i]["tp"], sweep[i]["fp"], sweep[i]["fn"]) == (tp, fp, fn)
        f2 = 5 * tp / (5 * tp + 4 * fn + fp) if (5 * tp + 4 * fn + fp) else 0.0
        assert abs(sweep[i]["f_beta"] - f2) < 1e-12
    best = evaluate.best_threshold(evaluate.threshold_sweep(df, "p", "y")).first()
    top = max(r["f_beta"] for r in sweep.values())
    first = min(i for i, r in sweep.items() if r["f_beta"] == top)
    assert best["i"] == first


def test_grid_threshold_exactness(spark):
    # scores sitting exactly on grid thresholds must count as >= t
    df = spark.createDataFrame([(i, i % 2, i / 200.0) for i in range(201)], "k long, y int, p double")
    sweep = {r["i"]: r for r in evaluate.threshold_sweep(df, "p", "y").collect()}
    for i in (0, 3, 29, 57, 58, 199, 200):
        assert sweep[i]["tp"] + sweep[i]["fp"] == 201 - i


def test_confusion_complete_and_sums(spark):
    rows, df = _fixture(spark)
    cm = evaluate.confusion_matrix(df, "p", "y", 0.5).collect()
    assert len(cm) == 4 and sum(r["n"] for r in cm) == len(rows)
    one_class = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.1)], "k long, y int, p double")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion_matrix(one_class, "p", "y", 0.5).collect()}
    assert cells == {(1, 1): 1, (0, 1): 0, (1, 0): 1, (0, 0): 0}


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.2)], "k long, y int, p double")
    rep = {r["class"]: r for r in evaluate.classification_report(df, "p", "y", 0.5).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["support"] == 0
    assert rep["accuracy"]["f1"] == 1.0


def test_min_rank_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (2, 0.9), (3, 0.9), (4, 0.5), (5, 0.1)], "k long, p double")
    ranks = {r["k"]: r["rank"] for r in ranking.min_rank_desc(df, "p").collect()}
    assert ranks == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_pr_curve_end_point_and_full_recall_cut(spark):
    rows, df = _fixture(spark, n=100)
    pts = evaluate.pr_curve(df, "p", "y", 0.5).collect()
    ends = [r for r in pts if r["score"] is None]
    assert len(ends) == 1 and ends[0]["precision"] == 1.0 and ends[0]["recall"] == 0.0
    full = [r for r in pts if r["score"] is not None and r["recall"] == 1.0]
    assert len(full) == 1  # curve stops at the first score reaching full recall
    assert sum(1 for r in pts if r["is_operating"]) == 1
