"""Lifecycle L3: curated table -> PCA -> clusterings -> outlier scores.

The fitted clusterings (k-means best-of-10, Gaussian mixture, density cut)
add ``Cluster_*`` columns next to the key (no positional ids, D5/D6);
the isolation forest adds its score; the reporting operators of
``churnkit.operators.segments`` / ``outliers`` then run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import lloyd, mixture, outliers, segments
from churnkit.plans import etl
from churnkit.plans.training import ROWS_PER_TASK
from churnkit.session import stored
from churnkit.sources import adapters
from churnkit.spec import DEFAULT_SPEC


def curated_features(spark: SparkSession, sf_dir: str, spec=DEFAULT_SPEC) -> tuple[DataFrame, list[str]]:
    cur = etl.curated_from_raw(adapters.raw_customers(spark, sf_dir), spec)
    mm = etl.model_matrix(cur, spec)
    return mm, [c for c in mm.columns if c not in (spec.key, spec.label)]


_WRITTEN: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: tuple, make):
    """What ``make`` returns, made once per application, source folder and name."""
    at = (spark.sparkContext.applicationId, sf_dir, *name)
    if at not in _WRITTEN:
        _WRITTEN[at] = make()
    return _WRITTEN[at]


def pca_frame(spark: SparkSession, sf_dir: str, target: float = 0.90):
    """PCA to >= target variance; returns (projected frame, k, explained variance)."""
    def make():
        mm, feats = curated_features(spark, sf_dir)
        model, k, ev, means = segments.pca_fit(mm, feats, target)
        proj = stored(spark, segments.pca_project(mm, feats, model, means, k, keep=["customer_id", "churn"]), "pca")
        return proj.coalesce(max(1, proj.count() // ROWS_PER_TASK)), k, ev
    return _once(spark, sf_dir, ("pca", target), make)


def kmeans_runs(spark: SparkSession, sf_dir: str, ks=segments.KS) -> list[lloyd.Run]:
    """Ten starts for each k, all in one fit."""
    return _once(spark, sf_dir, ("kmeans", tuple(ks)),
                 lambda: lloyd.fit_many(pca_frame(spark, sf_dir)[0], "pca", "customer_id", list(ks), segments.SEEDS))


def mixture_fits(spark: SparkSession, sf_dir: str, ks=segments.KS) -> list[mixture.Mixture]:
    """A Gaussian mixture for each k, all in one fit."""
    return _once(spark, sf_dir, ("mixtures", tuple(ks)),
                 lambda: mixture.fit_many(pca_frame(spark, sf_dir)[0], "pca", list(ks), segments.SEEDS[0]))


def k_sweep(spark: SparkSession, sf_dir: str, method: str, ks=segments.KS) -> DataFrame:
    """Silhouette of each k; of k-means for the best of its ten starts."""
    def make():
        proj = pca_frame(spark, sf_dir)[0]
        if method == "kmeans":
            return lloyd.sweep_table(proj, kmeans_runs(spark, sf_dir, ks))
        return mixture.sweep_table(proj, mixture_fits(spark, sf_dir, ks))
    return _once(spark, sf_dir, ("sweep", method, tuple(ks)), make)


def fitted_clusters(spark: SparkSession, sf_dir: str, k_kmeans: int | None = None, k_gmm: int | None = None,
                    ks=segments.KS) -> DataFrame:
    """K chosen by silhouette (first maximum) unless given; adds
    Cluster_KMeans and Cluster_GMM to the PCA-projected customers.  Both fits run at the same time: a round is a short job."""
    def make():
        proj = pca_frame(spark, sf_dir)[0]
        runs, mixtures = segments.parallel_map(lambda fit: fit(), [lambda: kmeans_runs(spark, sf_dir, [k_kmeans] if k_kmeans else ks),
                                                                   lambda: mixture_fits(spark, sf_dir, [k_gmm] if k_gmm else ks)])
        km, gm = segments.kmeans_chosen(runs), mixture.chosen(mixtures)
        out = segments.assign_nearest(proj, "pca", km.table(), "Cluster_KMeans", None)
        return stored(spark, mixture.assign(out, "pca", gm, "Cluster_GMM"), "clusters")
    return _once(spark, sf_dir, ("clusters", k_kmeans, k_gmm, tuple(ks)), make)


def clustered_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated features with PCA1/PCA2 and all cluster labels, written once."""
    def make():
        mm, _ = curated_features(spark, sf_dir)
        pca_frame(spark, sf_dir)  # made before the clusterings that read it at the same time
        cl, dens = segments.parallel_map(lambda make: make(spark, sf_dir), [fitted_clusters, density_clusters])
        cl = cl.select("customer_id", "PCA1", "PCA2", "pca", "Cluster_KMeans", "Cluster_GMM")
        dens = dens.select("customer_id", "Cluster_Density")
        return stored(spark, mm.join(cl, "customer_id").join(dens, "customer_id"), "clustered")
    return _once(spark, sf_dir, ("clustered",), make)


def isolation_scores(spark: SparkSession, sf_dir: str, contamination: float = 0.03, n_trees: int = 100) -> DataFrame:
    """O1 + O3: isolation-forest score, anomaly score (> 0 flagged) and label."""
    def make():  # scored once: the label rides along, and the cut and the result read the written scores
        mm, feats = curated_features(spark, sf_dir)
        return stored(spark, outliers.isolation_forest(mm, "customer_id", feats, n_trees=n_trees, keep=["churn"]), "isolation")
    scored = _once(spark, sf_dir, ("isolation", n_trees), make)
    cut = outliers.contamination_cut(scored, "iso_score", contamination)
    return outliers.flag_outliers(scored, "iso_score", cut, "IsoForest_Anomaly_Score", "outlier")


def density_clusters(spark: SparkSession, sf_dir: str, min_points: int = 5, min_cluster_size: int = 50,
                     cell_fraction: float = 0.25) -> DataFrame:
    """C6 (re-aimed): grid density clusters in the PCA1/PCA2 plane; cell side =
    ``cell_fraction`` x the mean standard deviation of the two coordinates."""
    from churnkit.operators.density import grid_density_clusters
    def make():
        proj, _, _ = pca_frame(spark, sf_dir)
        s = proj.agg(F.stddev_samp("PCA1").alias("a"), F.stddev_samp("PCA2").alias("b")).first()
        cell = cell_fraction * ((s["a"] or 1.0) + (s["b"] or 1.0)) / 2.0
        return stored(spark, grid_density_clusters(proj, "customer_id", ["PCA1", "PCA2"], cell, min_points, min_cluster_size,
                                                   "Cluster_Density", keep=["churn"]), "density")
    return _once(spark, sf_dir, ("density", min_points, min_cluster_size, cell_fraction), make)
