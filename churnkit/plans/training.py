"""Lifecycle L2: curated table -> split -> tuned classifiers -> reports.

``model_table``, the fitted models and all customers' scores are written to the shared folder
once per application and source folder; every report reads them from there.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import evaluate, models, split
from churnkit.plans import etl
from churnkit.session import scratch_path, stored
from churnkit.sources import adapters
from churnkit.spec import DEFAULT_SPEC

#: Rows that a fit gives one task at least: small tables are not cut into empty tasks.
ROWS_PER_TASK = 20_000
_TABLES: dict[tuple, tuple[DataFrame, list[str]]] = {}
_FITTED: dict[tuple, str] = {}
_SCORES: dict[tuple, DataFrame] = {}


def _at(spark: SparkSession, sf_dir: str, *more) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, *more)


def model_table(spark: SparkSession, sf_dir: str, spec=DEFAULT_SPEC) -> tuple[DataFrame, list[str]]:
    """Finite-cleaned features (P9), 0/1 label, split and fold (M1/M2)."""
    at = _at(spark, sf_dir, repr(spec))
    if at not in _TABLES:
        cur = etl.curated_from_raw(adapters.raw_customers(spark, sf_dir), spec)
        mm = etl.model_matrix(cur, spec)
        feats = [c for c in mm.columns if c not in (spec.key, spec.label)]
        table = stored(spark, split.stratified_split(mm, spec.label, spec.key), "model-table")
        parts = max(1, table.count() // ROWS_PER_TASK)
        _TABLES[at] = (table.coalesce(parts) if parts < table.rdd.getNumPartitions() else table, feats)
    return _TABLES[at]


def baseline_report(data: DataFrame, feats, label: str = "churn", key: str = "customer_id") -> DataFrame:
    """M6: weighted LR fitted on everything but the test split, classification report at t = 0.5 on test."""
    spec = models.DEFAULT_MODELS[0]
    m = models.fit(data.where(F.col("split").isin("train", "val")), spec, feats, label)
    p = models.predict_proba(m, data.where(F.col("split") == "test"), [key, label])
    return evaluate.classification_report(p, "p", label, 0.5)


def fitted_path(spark: SparkSession, sf_dir: str, spec: models.ModelSpec, label: str = "churn", key: str = "customer_id") -> str:
    """Folder of one model, trained with cross-validation and saved with its manifest."""
    at = _at(spark, sf_dir, spec.name)
    if at not in _FITTED:
        data, feats = model_table(spark, sf_dir)
        path = scratch_path(spark, "models")
        models.save_models(models.train_all(data, feats, label, key, (spec,), cv=True), path)
        _FITTED[at] = path
    return _FITTED[at]


def load_fitted(spark: SparkSession, sf_dir: str, specs=models.DEFAULT_MODELS) -> tuple[dict, list]:
    """(loaded models by name, manifest rows) of the saved models; those not fitted yet are fitted as concurrent jobs."""
    from churnkit.operators.segments import parallel_map

    loaded, rows = {}, []
    model_table(spark, sf_dir)
    for path in parallel_map(lambda spec: fitted_path(spark, sf_dir, spec), list(specs)):
        found, manifest = models.load_models(path)
        loaded |= found
        rows += manifest.collect()
    return loaded, rows


def manifest_table(spark: SparkSession, sf_dir: str, specs=models.DEFAULT_MODELS) -> DataFrame:
    """M9/M11/M18 from the manifests: per model the tuned threshold, CV and test metrics."""
    rows = []
    for r in load_fitted(spark, sf_dir, specs)[1]:
        m = json.loads(r["metrics"])
        rows.append((r["model"], r["default_threshold"], m["cv_roc_auc"], m["cv_f2_at_05"], m["test_auc"], m["test_precision"],
                     m["test_recall"], m["test_f2"], len(r["feature_order"])))
    return spark.createDataFrame(rows, "model string, threshold double, cv_auc double, cv_f2_at_05 double, test_auc double, "
                                       "test_precision double, test_recall double, test_f2 double, n_features int")


def fitted_scores(spark: SparkSession, sf_dir: str, specs=models.DEFAULT_MODELS) -> DataFrame:
    """Every customer scored by the loaded models, with decisions, votes and consensus, written once."""
    at = _at(spark, sf_dir, "scores", *[s.name for s in specs])
    if at not in _SCORES:
        loaded, rows = load_fitted(spark, sf_dir, specs)
        data, _ = model_table(spark, sf_dir)
        scores = models.score_all(loaded, {r["model"]: r["default_threshold"] for r in rows}, data, "customer_id", "churn")
        _SCORES[at] = stored(spark, scores, "fitted-scores")
    return _SCORES[at]
