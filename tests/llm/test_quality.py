import zlib

import numpy as np
import pytest

from churnkit.llm import quality as Q

DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.score_documents(spark, docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    for q in (0, 1):
        assert (held.predicted == q)[held.quality == q].mean() > 0.95


def test_scores_equal_the_network(spark):
    """The collapsed scorer gives what vectors, average and softmax give."""
    texts = [b"a b c", "é wort wort".encode(), b"x", b"", None, b"good good !!"] * 20
    y = np.array([1, 0, 1, 1, 0, 0] * 20)
    model = Q.fit(texts, y, bits=10, epochs=3)
    for t, s in zip(texts[:6], Q.scores(texts[:6], model), strict=True):
        f, w = Q.bags([t], 10)[0]
        assert s == pytest.approx(1 / (1 + np.exp(-(float(model.weight[f] @ w) + model.bias))), abs=1e-5)
    apart = [Q.scores([t], model)[0] for t in texts[:6]]
    assert apart == pytest.approx(Q.scores(texts[:6], model).tolist())


def test_edges(spark, docs, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (4, 5, 0), (99, 1, 0), (1, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "good text"), (2, "bad"), (3, None), (4, ""), (5, "long " * 60_000), (None, "x"), (2, "bad")]
    got = Q.score_documents(spark, docs(rows), labels).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    assert Q.score_documents(spark, docs([]), labels).count() == 0
    none = Q.score_documents(spark, clashing(rows), labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}


def test_only_train_rows_teach(spark, docs):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "alpha beta" if i % 2 else "gamma delta") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in out], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in Q.score_documents(spark, docs(rows), labels).collect()} == {0.5}
