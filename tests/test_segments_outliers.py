"""Segmentation and outlier operators against brute force and invariants."""

import math
import random

from churnkit.operators import outliers, segments


def _points(spark, n=60, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        c = i % 3
        rows.append((i, c, [rnd.gauss(3.0 * c, 1.0), rnd.gauss(-c, 1.0)]))
    return rows, spark.createDataFrame(rows, "id long, c int, v array<double>")


def test_sq_euclidean_silhouette_matches_pairs(spark):
    rows, df = _points(spark)
    pts = {r["id"]: r["silhouette"] for r in segments.silhouette_points(df, "v", "c").collect()}

    def d2(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))
    for i, ci, vi in rows[:12]:
        by = {}
        for j, cj, vj in rows:
            if j != i:
                by.setdefault(cj, []).append(d2(vi, vj))
        a = sum(by[ci]) / len(by[ci])
        b = min(sum(v) / len(v) for k, v in by.items() if k != ci)
        assert abs(pts[i] - (b - a) / max(a, b)) < 1e-9


def test_silhouette_singletons_and_noise(spark):
    df = spark.createDataFrame([(1, 0, [0.0]), (2, 1, [5.0]), (3, 1, [6.0]), (4, -1, [100.0])],
                               "id long, c int, v array<double>")
    pts = {r["id"]: r["silhouette"] for r in segments.silhouette_points(df, "v", "c", noise=-1).collect()}
    assert 4 not in pts and pts[1] == 0.0
    one = spark.createDataFrame([(1, 0, [0.0]), (2, 0, [1.0])], "id long, c int, v array<double>")
    assert segments.silhouette_score(one, "v", "c") is None
    noise_only = spark.createDataFrame([(1, -1, [0.0])], "id long, c int, v array<double>")
    assert segments.silhouette_score(noise_only, "v", "c", noise=-1) is None


def test_assign_nearest_and_identical_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [10.0, 10.0])], "id long, v array<double>")
    out = {r["id"]: (r["cluster"], r["distance"])
           for r in segments.assign_nearest(df, "v", [(7, [0.0, 0.0]), (9, [10.0, 9.0])]).collect()}
    assert out == {1: (7, 0.0), 2: (7, 0.0), 3: (9, 1.0)}


def test_churn_variance_population_and_single_cluster(spark):
    prof = spark.createDataFrame([(0, 0.2), (1, 0.4)], "cluster int, churn_rate double")
    v = segments.churn_variance(prof).first()
    assert abs(v["churn_variance"] - 0.01) < 1e-15 and v["n_clusters"] == 2
    one = spark.createDataFrame([(0, 0.3)], "cluster int, churn_rate double")
    assert segments.churn_variance(one).first()["churn_variance"] == 0.0


def test_cluster_kpis_ties(spark):
    prof = spark.createDataFrame([(0, 0.5), (1, 0.5), (2, 0.1)], "cluster int, churn_rate double")
    k = segments.cluster_kpis(prof, "cluster").first()
    assert (k["n_clusters"], k["highest_cluster"], k["lowest_cluster"]) == (3, 0, 2)


def test_isolation_forest_flags_the_far_point(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(400)] + [(999, 12.0, -12.0)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    s = outliers.isolation_forest(df, "k", ["a", "b"], n_trees=50, max_samples=128)
    scores = {r["k"]: r["iso_score"] for r in s.collect()}
    assert len(scores) == 401
    assert scores[999] == max(scores.values()) and scores[999] > 0.6
    assert all(0.0 < v < 1.0 for v in scores.values())
    cut = outliers.contamination_cut(s, "iso_score", 0.03)
    flagged = outliers.flag_outliers(s, "iso_score", cut).where("outlier = -1").count()
    assert 10 <= flagged <= 13


def test_t_pvalue_known_values():
    # two-sided p of Student t: t=2.0, dof=10 -> 0.0734; t=0 -> 1
    assert abs(outliers.t_two_sided_p(2.0, 10) - 0.07338803477074) < 1e-9
    assert abs(outliers.t_two_sided_p(0.0, 5) - 1.0) < 1e-12
    # large dof approaches the normal tail
    assert abs(outliers.t_two_sided_p(1.96, 1e6) - math.erfc(1.96 / math.sqrt(2))) < 1e-5


def test_point_biserial_equals_pearson(spark):
    rows = [(i, i % 2, float(i) + (i % 2) * 3.0) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    r = outliers.point_biserial(df, "y", "s").first()
    ys = [y for _, y, _ in rows]
    ss = [s for _, _, s in rows]
    my, ms = sum(ys) / 50, sum(ss) / 50
    num = sum((a - my) * (b - ms) for a, b in zip(ys, ss))
    den = math.sqrt(sum((a - my) ** 2 for a in ys) * sum((b - ms) ** 2 for b in ss))
    assert abs(r["r"] - num / den) < 1e-12 and r["n"] == 50
