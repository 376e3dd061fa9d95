"""Gaussian mixtures: the joint fit against Spark ML's estimator, fit by fit."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnkit.operators import mixture


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, s, (70, 3)) for m, s in ((0, 1), (6, 0.5), (-5, 2))])
    x[:, 2] += np.round(x[:, 0])
    path = __import__("tempfile").mkdtemp(prefix="churnkit-mixture-", dir="/tmp") + "/t"
    rows = [(i, [float(v) for v in row], None if i % 7 else "t") for i, row in enumerate(x)]
    spark.createDataFrame(rows, "id long, vec array<double>, note string").repartition(3, "id").write.parquet(path)
    return spark.read.parquet(path)


def test_all_k_at_once_equal_spark_ml(spark, points):
    vectors = points.withColumn("features", array_to_vector("vec"))
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    fits = mixture.fit_many(points, "vec", [2, 3, 4], seed=42)
    for m in fits:
        model = GaussianMixture(k=m.k, seed=42, featuresCol="features", maxIter=100).fit(vectors)
        want = model.transform(vectors)
        assert np.allclose(m.weights, model.weights, atol=1e-9)
        assert np.allclose(m.means + m.origin, [g["mean"].toArray() for g in model.gaussiansDF.collect()], atol=1e-7)
        assert abs(m.silhouette - evaluator.evaluate(want)) < 1e-9
        got = mixture.assign(points, "vec", m, "label")
        assert got.columns == [*points.columns, "label"] and got.schema["label"].dataType.simpleString() == "int"
        both = got.join(want.select("id", "prediction"), "id")
        assert both.count() == 210 and both.where(F.col("label") != F.col("prediction")).count() == 0
    table = mixture.sweep_table(points, fits).collect()
    first = max(table, key=lambda r: (r["silhouette"], -r["k"]))
    assert mixture.chosen(fits).k == first["k"] and [r["method"] for r in table] == ["gmm"] * 3


def test_a_sweep_has_no_job_per_mixture_and_round(spark, points):
    """A round is one job, however many mixtures go on (Spark ML's fits ran a job for each)."""
    calls, collect = [], mixture._collect
    try:
        mixture._collect = lambda df, task, shapes: calls.append(len(shapes)) or collect(df, task, shapes)
        fits = mixture.fit_many(points, "vec", [2, 3, 4], rounds=4, tol=-1.0)
    finally:
        mixture._collect = collect
    assert calls[:4] == [3] * 4 and len(calls) == 6 and [m.rounds for m in fits] == [4] * 3


def test_one_label_has_no_silhouette(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(20)], "id long, vec array<double>")
    one = mixture.fit_many(same, "vec", [2], rounds=0)[0]
    assert one.silhouette is None and mixture.chosen([one]) is one


def test_clusterings_are_fitted_at_the_same_time(spark, monkeypatch):
    """Before: the mixtures began when all k-means runs had ended."""
    import threading
    from types import SimpleNamespace

    from churnkit.plans import segmentation

    both, df = threading.Barrier(2), spark.range(3)

    def fit(*_):
        both.wait(timeout=20)
        return []
    monkeypatch.setattr(segmentation, "pca_frame", lambda *a: (df, 2, []))
    monkeypatch.setattr(segmentation, "kmeans_runs", fit)
    monkeypatch.setattr(segmentation, "mixture_fits", fit)
    monkeypatch.setattr(segmentation.segments, "kmeans_chosen", lambda runs: SimpleNamespace(table=lambda: []))
    monkeypatch.setattr(segmentation.segments, "assign_nearest", lambda proj, *a: proj)
    monkeypatch.setattr(segmentation.mixture, "chosen", lambda fits: None)
    monkeypatch.setattr(segmentation.mixture, "assign", lambda proj, *a: proj)
    assert segmentation.fitted_clusters(spark, "no folder").count() == 3
