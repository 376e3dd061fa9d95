"""Class-weighted classifiers, out-of-fold CV, threshold tuning, refit and
persistence (M5-M9, M11, M18, M24, E7).

Logistic regression (``operators.newton``), the random forest (``operators.forest``) and boosted
trees (``operators.boosting``) fit the folds and both refits together.  This module wires folds
and evaluation.  Probabilities are not rounded.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.operators import boosting, evaluate, forest, newton
from churnkit.session import release, stored


@dataclass
class ModelSpec:
    name: str
    kind: str  # "lr" | "rf" | "gbt"
    params: dict


# The reference's model settings (C=1 L2 logistic regression with
# balanced weights and <= 2000 iterations; 200 balanced trees; 200 boosted trees
# of depth 5, learning rate 0.1, row/column sampling 0.9).
DEFAULT_MODELS = (
    ModelSpec("LogisticRegression", "lr", {"maxIter": 2000}),
    ModelSpec("RandomForest", "rf", {"numTrees": 200, "maxDepth": 30, "featureSubsetStrategy": "sqrt"}),
    ModelSpec("BoostedTrees", "gbt", {"rounds": 200, "depth": 5, "rate": 0.1, "rows": 0.9, "columns": 0.9}),
)


def _session() -> SparkSession:
    """The running session.  Only the thread that made it has it as its active one, and models are also saved and loaded from others."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def fit(df: DataFrame, spec: ModelSpec, features: Sequence[str], label: str, seed: int = 42):
    """M5, M7: one model on all rows of ``df``."""
    if spec.kind == "lr":
        return newton.fit_many(df, features, label, {"all": F.lit(True)}, max_steps=spec.params["maxIter"])["all"]
    return forest.fit_many(df, features, label, None, {"all": F.lit(True)}, forest.ForestParams(seed=seed, **spec.params))["all"]


def predict_proba(model, df: DataFrame, keep: Sequence[str], out: str = "p") -> DataFrame:
    """Positive-class probability next to ``keep`` columns, of any fitted model."""
    if isinstance(model, boosting.Booster):
        return boosting.predict(df, {None: model}, keep, out=out)
    if isinstance(model, newton.LogisticModel):
        return newton.predict(df, {None: model}, keep, out=out)
    return forest.predict(df, model, keep, out=out)


def oof_predictions(train: DataFrame, spec: ModelSpec, features: Sequence[str], label: str, key: str,
                    fold_col: str = "fold", folds: int = 5) -> DataFrame:
    """M9: out-of-fold probabilities — fit on fold != i, score fold i."""
    if spec.kind == "lr":  # all folds in one fit, each row scored by the model of its fold
        fits = newton.fit_many(train, features, label, {i: F.col(fold_col) != i for i in range(folds)}, max_steps=spec.params["maxIter"])
        return newton.predict(train, fits, [key, label], by=fold_col)
    fits = forest.fit_many(train, features, label, key, {f"fold{i}": F.col(fold_col) != i for i in range(folds)}, forest.ForestParams(**spec.params))
    return forest_oof(train, fits, label, key, fold_col, folds)


def forest_oof(train: DataFrame, fits: dict, label: str, key: str, fold_col: str = "fold", folds: int = 5) -> DataFrame:
    """The rows of every fold scored by the forest ``fold<i>``, which has not seen them."""
    parts = [forest.predict(train.where(F.col(fold_col) == i), fits[f"fold{i}"], [key, label]) for i in range(folds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cv_metrics(oof: DataFrame, label: str) -> dict:
    """M9: one evaluation over all out-of-fold rows: exact AUC and F2 at 0.5."""
    auc = evaluate.roc_auc(oof, "p", label).first()["auc"]
    k = evaluate.threshold_kpis(oof, "p", label, 0.5).first()
    return {"cv_roc_auc": auc, "cv_f2_at_05": k["f2"]}


def tune_threshold(model, val: DataFrame, label: str, key: str, steps: int = 200) -> float:
    """F2-maximising threshold on the validation rows (first maximum)."""
    p = stored(val.sparkSession, predict_proba(model, val, [key, label]), "val-scores")
    best = evaluate.best_threshold(evaluate.threshold_sweep(p, "p", label, steps=steps)).first()
    release(val.sparkSession, p)
    return float(best["threshold"])


def lr_coefficients(model: newton.LogisticModel) -> DataFrame:
    """M24 + P20 + W3: coefficient, odds ratio, sorted by |coefficient| (d rows)."""
    df = _session().createDataFrame(list(zip(model.features, model.coefficients)), "feature string, coefficient double")
    return df.select("feature", "coefficient", F.exp("coefficient").alias("odds_ratio")).orderBy(
        F.abs("coefficient").desc(), "feature")


@dataclass
class TrainedModel:
    spec: ModelSpec
    model: object  # Forest, Booster or LogisticModel
    threshold: float
    metrics: dict
    features: list


def train_all(data: DataFrame, features: Sequence[str], label: str, key: str,
              specs: Sequence[ModelSpec] = DEFAULT_MODELS, cv: bool = True) -> dict[str, TrainedModel]:
    """Lifecycle L2: split column -> OOF CV per model -> fit on train, tune the
    threshold on val -> refit on train+val (R3) -> evaluate on test (M18)."""
    val = data.where(F.col("split") == "val")
    test = data.where(F.col("split") == "test")
    out = {}
    for spec in specs:
        metrics, tune_model, final = joint_fits(data, spec, features, label, key, cv)
        t = tune_threshold(tune_model, val, label, key)
        p_test = stored(data.sparkSession, predict_proba(final, test, [key, label]), "test-scores")
        k = evaluate.threshold_kpis(p_test, "p", label, t).first()
        metrics.update({"test_recall": k["recall"], "test_precision": k["precision"], "test_f2": k["f2"],
                        "test_auc": evaluate.roc_auc(p_test, "p", label).first()["auc"]})
        release(data.sparkSession, p_test)
        out[spec.name] = TrainedModel(spec, final, t, metrics, list(features))
    return out


def training_sets(folds: int = 5, cv: bool = True, fold_col: str = "fold") -> dict:
    """The training sets of the protocol as conditions: a fold left out each (M9), train (M11), train + val."""
    train = F.col("split") == "train"
    out = {f"fold{i}": train & (F.col(fold_col) != i) for i in range(folds)} if cv else {}
    return out | {"tune": train, "final": F.col("split").isin("train", "val")}


def joint_fits(data: DataFrame, spec: ModelSpec, features: Sequence[str], label: str, key: str, cv: bool = True, folds: int = 5):
    """(metrics, model fitted on train, model fitted on train + val): one fit of all training sets."""
    sets = training_sets(folds, cv)
    if spec.kind == "rf":
        fits = forest.fit_many(data, features, label, key, sets, forest.ForestParams(**spec.params))
        metrics = {}
        if cv:
            oof = stored(data.sparkSession, forest_oof(data.where(F.col("split") == "train"), fits, label, key, folds=folds), "forest-oof")
            metrics = cv_metrics(oof, label)
            release(data.sparkSession, oof)
        return metrics, fits["tune"], fits["final"]
    if spec.kind == "gbt":
        fits, predict = boosting.fit_many(data, features, label, key, sets, boosting.BoostParams(**spec.params)), boosting.predict
    else:
        fits, predict = newton.fit_many(data, features, label, sets, max_steps=spec.params["maxIter"]), newton.predict
    metrics = {}
    if cv:
        oof = stored(data.sparkSession, predict(data.where(F.col("split") == "train"), {i: fits[f"fold{i}"] for i in range(folds)}, [key, label], by="fold"),
                     f"{spec.kind}-oof")
        metrics = cv_metrics(oof, label)
        release(data.sparkSession, oof)
    if spec.kind == "gbt":
        metrics["losses"] = {name: b.losses for name, b in fits.items()}
    else:
        metrics["fits"] = {name: [m.steps, m.objective, m.gradient] for name, m in fits.items()}
    return metrics, fits["tune"], fits["final"]


def save_models(models: dict[str, TrainedModel], out_dir: str) -> DataFrame:
    """One folder per model (forest, booster or regression) plus a manifest table (JSON)."""
    spark = _session()
    rows = []
    for name, tm in models.items():
        path = f"{out_dir.rstrip('/')}/{name.lower()}"
        tm.model.save(spark, path)
        rows.append((name, path, tm.spec.kind, float(tm.threshold), tm.features, json.dumps(tm.metrics)))
    manifest = spark.createDataFrame(rows, "model string, path string, kind string, default_threshold double, "
                                           "feature_order array<string>, metrics string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{out_dir.rstrip('/')}/manifest")
    return manifest


def load_models(out_dir: str) -> tuple[dict, DataFrame]:
    """Manifest table and the fitted models it names."""
    spark = _session()
    manifest = spark.read.json(f"{out_dir.rstrip('/')}/manifest")
    load = {"gbt": boosting.Booster.load, "lr": newton.LogisticModel.load, "rf": forest.Forest.load}
    models = {r["model"]: load[r["kind"]](spark, r["path"])
              for r in manifest.select("model", "path", "kind").collect()}
    return models, manifest


def score_all(models: dict, thresholds: dict, df: DataFrame, key: str, label: str) -> DataFrame:
    """M20 with fitted models: p_<m>, pred_<m>, votes and consensus per row
    (chained transforms, no join)."""
    from churnkit.operators.scoring import consensus
    cur, cols = df, []
    for name, m in models.items():
        cur = predict_proba(m, cur, cur.columns, out=f"p_{name}")
        cols.append(f"p_{name}")
    scored = cur.select(key, F.col(label).alias("churn_actual"), *cols)
    return consensus(scored, {n: thresholds[n] for n in models})
