"""End-to-end publish job on the smallest tables (models skipped for time)."""

import tempfile

from churnkit.plans.publish import publish

from paths import SF_SMALL


def test_publish_writes_keyed_layers(spark):
    out = tempfile.mkdtemp(prefix="churnkit-publish-", dir="/tmp")
    w = publish(spark, SF_SMALL, out, train_models=False)
    raw = spark.read.parquet(w["raw"])
    cur = spark.read.parquet(w["curated"])
    clustered = spark.read.parquet(w["segments/clustered"])
    scores = spark.read.parquet(w["outliers/all_scores"])
    n = raw.count()
    assert cur.count() == clustered.count() == scores.count() == n
    assert "customer_id" in cur.columns  # key kept in the curated layer (D6)
    assert {"PCA1", "PCA2", "Cluster_KMeans", "Cluster_GMM", "Cluster_Density"} <= set(clustered.columns)
    assert scores.select("customer_id").distinct().count() == n
    comp = {r["method"]: r for r in spark.read.json(w["segments/comparison"]).collect()}
    assert set(comp) == {"Cluster_KMeans", "Cluster_GMM", "Cluster_Density"}
