"""Model fits, persistence with manifest (E7) and layer IO round trips."""

import tempfile

from pyspark.sql import functions as F

from churnkit.operators import models
from churnkit.plans import training
from churnkit.sources import layers

from paths import SF_SMALL


def test_lr_fit_save_load_and_score(spark):
    data, feats = training.model_table(spark, SF_SMALL)
    spec = models.ModelSpec("LogisticRegression", "lr", {"maxIter": 200})
    m = models.fit(data.where(F.col("split") != "test"), spec, feats, "churn")
    coefs = models.lr_coefficients(m).collect()
    assert len(coefs) == len(feats)
    assert abs(coefs[0]["odds_ratio"] - __import__("math").exp(coefs[0]["coefficient"])) < 1e-12
    out = tempfile.mkdtemp(prefix="churnkit-models-", dir="/tmp")
    tm = models.TrainedModel(spec, m, 0.305, {"cv_roc_auc": 0.5}, feats)
    models.save_models({"LogisticRegression": tm}, out)
    loaded, manifest = models.load_models(out)
    row = manifest.first()
    assert row["default_threshold"] == 0.305 and list(row["feature_order"]) == feats
    a = models.predict_proba(m, data, ["customer_id"]).orderBy("customer_id").collect()
    b = models.predict_proba(loaded["LogisticRegression"], data, ["customer_id"]).orderBy("customer_id").collect()
    assert a == b
    assert all(0.0 <= r["p"] <= 1.0 for r in a)
    votes = models.score_all(loaded, {"LogisticRegression": 0.305}, data, "customer_id", "churn")
    assert set(votes.columns) >= {"p_LogisticRegression", "pred_LogisticRegression", "consensus_label"}


def test_models_are_saved_and_loaded_from_other_threads(spark):
    from concurrent.futures import ThreadPoolExecutor

    from churnkit.operators.newton import LogisticModel

    def one(name):
        tm = models.TrainedModel(models.ModelSpec(name, "lr", {}), LogisticModel(["a"], [0.5], 0.25), 0.5, {}, ["a"])
        out = tempfile.mkdtemp(prefix="churnkit-models-", dir="/tmp")
        models.save_models({name: tm}, out)
        loaded, manifest = models.load_models(out)
        return models.lr_coefficients(loaded[name]).first()["coefficient"], manifest.first()["model"]
    with ThreadPoolExecutor(2) as ex:
        assert list(ex.map(one, ["m", "n"])) == [(0.5, "m"), (0.5, "n")]


def test_csv_roundtrip_keeps_blank_text(spark):
    df = spark.createDataFrame([(1, " ", None), (2, "3.5", "x")], "k long, t string, u string")
    path = layers.write_csv(df, tempfile.mkdtemp(prefix="churnkit-csv-", dir="/tmp") + "/t")
    back = sorted(tuple(r) for r in layers.read_csv(spark, path, "k long, t string, u string").collect())
    assert back == [(1, " ", None), (2, "3.5", "x")]


def test_scores_of_all_customers_are_written_once(spark, monkeypatch):
    """Before: every use of the scores ran all models again."""
    from churnkit.plans import training

    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "customer_id long, churn int")
    monkeypatch.setattr(training, "load_fitted", lambda *a: ({}, []))
    monkeypatch.setattr(training, "model_table", lambda *a: (df, []))
    monkeypatch.setattr(training.models, "score_all", lambda loaded, thresholds, data, key, label: data.select(key, label))
    scores = training.fitted_scores(spark, "some folder")
    assert scores.inputFiles() and scores.count() == 20
    assert training.fitted_scores(spark, "some folder") is scores and training.fitted_scores(spark, "another") is not scores
