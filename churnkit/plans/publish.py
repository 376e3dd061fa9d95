"""End-to-end job: build and write every layer and result table.

    python -m churnkit.plans.publish --sf-dir /root/testdata/sf0.01 --out <shared folder> [--skip-models]

Writes (all under ``--out``, Parquet unless noted):

* ``layers/raw``, ``layers/staging``, ``layers/curated`` (E3)
* ``olap/<view>`` CSV result tables (E4): rates by segment / tenure cohort /
  priority / region, the cross-tab, the six-series grouping-sets table
* ``segments/clustered``: curated rows + PCA1/PCA2 + Cluster_KMeans /
  Cluster_GMM / Cluster_Density (the layer the reference reads but never writes, D7)
* ``segments/comparison`` (E6): clusters (noise excluded) and churn variance per method
* ``outliers/all_scores``: isolation-forest and distance scores for every row, keyed
* ``models/<name>`` + ``models/manifest`` (E7), ``models/report`` (E6)

The curated layer is re-read from its written files by every later stage, so
the expensive derivation runs once and lineage is cut at a durable table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from churnkit.operators import lloyd, mixture, models, olap, outliers, segments, split
from churnkit.operators.density import grid_density_clusters
from churnkit.plans import etl
from churnkit.plans.catalog import BIN_KW, REGIONS
from churnkit.session import stored
from churnkit.sources import adapters, layers
from churnkit.spec import DEFAULT_SPEC


def publish(spark: SparkSession, sf_dir: str, out: str, train_models: bool = True, spec=DEFAULT_SPEC) -> dict:
    out = out.rstrip("/")
    written = {}
    # L1: layers
    raw = adapters.raw_customers(spark, sf_dir)
    written.update(etl.write_layers(spark, etl.build_layers(raw, spec), f"{out}/layers"))
    raw = layers.read_parquet(spark, written["raw"])
    curated = layers.read_parquet(spark, written["curated"])
    # L1: OLAP result tables
    framed = olap.olap_frame(raw, **BIN_KW)
    views = {
        "churn_by_segment": olap.churn_rate_by(framed, spec.contract),
        "churn_by_tenure_cohort": olap.churn_rate_by(framed, "tenure_cohort"),
        "churn_by_priority": olap.churn_rate_by(framed, spec.payment),
        "churn_by_region": olap.churn_rate_by(framed, spec.internet),
        "churn_segment_x_region": olap.crosstab(raw, spec.contract, spec.internet, REGIONS),
        "olap_series": olap.olap_series(raw, **BIN_KW),
    }
    for name, df in views.items():
        written[f"olap/{name}"] = layers.write_csv(df.coalesce(1), f"{out}/olap/{name}")
    # L3: segmentation on the written curated layer
    mm = etl.model_matrix(curated, spec)
    feats = [c for c in mm.columns if c not in (spec.key, spec.label)]
    pca_model, k, _, means = segments.pca_fit(mm, feats)
    proj = segments.pca_project(mm, feats, pca_model, means, k, keep=[spec.key, spec.label])
    proj = stored(spark, proj, "pca")
    km = segments.kmeans_chosen(lloyd.fit_many(proj, "pca", spec.key, segments.KS, segments.SEEDS))
    gm = mixture.chosen(mixture.fit_many(proj, "pca", segments.KS, segments.SEEDS[0]))
    cl = mixture.assign(segments.assign_nearest(proj, "pca", km.table(), "Cluster_KMeans", None), "pca", gm, "Cluster_GMM")
    s = proj.agg(F.stddev_samp("PCA1").alias("a"), F.stddev_samp("PCA2").alias("b")).first()
    cell = 0.25 * ((s["a"] or 1.0) + (s["b"] or 1.0)) / 2.0
    dens = grid_density_clusters(proj, spec.key, ["PCA1", "PCA2"], cell, 5, 50, "Cluster_Density")
    clustered = (curated.join(cl.select(spec.key, "PCA1", "PCA2", "Cluster_KMeans", "Cluster_GMM"), spec.key)
                 .join(dens.select(spec.key, "Cluster_Density"), spec.key))
    written["segments/clustered"] = layers.write_parquet(clustered, f"{out}/segments/clustered")
    clustered = layers.read_parquet(spark, written["segments/clustered"])
    rows = []
    for m in ("Cluster_KMeans", "Cluster_GMM", "Cluster_Density"):
        prof = segments.cluster_profile(clustered, m, ["tenure", "monthly"], spec.label, noise=-1)
        written[f"segments/profile_{m}"] = layers.write_csv(prof.coalesce(1), f"{out}/segments/profile_{m}")
        v = segments.churn_variance(prof).first()
        rows.append((m, int(v["n_clusters"]), float(v["churn_variance"])))
    comp = spark.createDataFrame(rows, "method string, n_clusters int, churn_variance double")
    written["segments/comparison"] = layers.write_report(comp, f"{out}/segments/comparison")
    # L3: outliers for every row, keyed (fixes D5: no positional index)
    iso = outliers.isolation_forest(mm, spec.key, feats)
    scored = clustered.select(spec.key, spec.label, "PCA1", "PCA2", "Cluster_KMeans", "Cluster_GMM",
                              "Cluster_Density", outliers.centroid_distance(list(spec.numeric)).alias("distance_score"))
    scored = scored.join(iso, spec.key)
    cut = outliers.contamination_cut(scored, "iso_score", 0.03)
    scored = outliers.flag_outliers(scored, "iso_score", cut, "IsoForest_Anomaly_Score", "IsoForest_Label")
    written["outliers/all_scores"] = layers.write_parquet(scored, f"{out}/outliers/all_scores")
    # L2: models
    if train_models:
        data = split.stratified_split(mm, spec.label, spec.key).persist()
        trained = models.train_all(data, feats, spec.label, spec.key, cv=True)
        models.save_models(trained, f"{out}/models")
        rep = spark.createDataFrame([(n, t.threshold, t.metrics.get("cv_roc_auc"), t.metrics.get("test_auc"),
                                      t.metrics.get("test_recall"), t.metrics.get("test_f2"))
                                     for n, t in trained.items()],
                                    "model string, threshold double, cv_auc double, test_auc double, "
                                    "test_recall double, test_f2 double")
        written["models/report"] = layers.write_report(rep, f"{out}/models/report")
        data.unpersist()
    return written


def main(argv=None):
    from churnkit.session import build_session, scratch_path
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None, help="output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--skip-models", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    out = a.out or scratch_path(spark, "publish")
    for k, v in publish(spark, a.sf_dir, out, not a.skip_models).items():
        print(f"{k}\t{v}")


if __name__ == "__main__":
    main()
