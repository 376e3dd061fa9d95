"""Grid density clustering: separated blobs, noise, degenerate inputs."""

import random

from churnkit.operators.density import cluster_count, grid_density_clusters


def _blobs(spark, noise_pts=30):
    rnd = random.Random(11)
    rows = []
    k = 0
    for cx, cy in ((0.0, 0.0), (10.0, 10.0)):
        for _ in range(120):
            rows.append((k, rnd.gauss(cx, 0.5), rnd.gauss(cy, 0.5)))
            k += 1
    for _ in range(noise_pts):
        rows.append((k, rnd.uniform(-20, 30), rnd.uniform(30, 60)))
        k += 1
    return spark.createDataFrame(rows, "id long, x double, y double")


def test_two_blobs_and_noise(spark):
    df = _blobs(spark)
    out = grid_density_clusters(df, "id", ["x", "y"], cell=0.5, min_points=3, min_cluster_size=50)
    got = {r["id"]: r["cluster"] for r in out.collect()}
    assert len(got) == df.count()
    assert cluster_count(out, "cluster") == 2
    a = {got[i] for i in range(0, 120)} - {-1}
    b = {got[i] for i in range(120, 240)} - {-1}
    assert len(a) == 1 and len(b) == 1 and a != b
    assert all(got[i] == -1 for i in range(240, 270))


def test_all_noise(spark):
    df = spark.createDataFrame([(i, float(i * 10), 0.0) for i in range(20)], "id long, x double, y double")
    out = grid_density_clusters(df, "id", ["x", "y"], cell=1.0, min_points=3, min_cluster_size=5)
    assert {r["cluster"] for r in out.collect()} == {-1}
    assert cluster_count(out, "cluster") == 0
