"""Batched Newton steps: the optimum against plain numpy, folds together and alone, edge cases, persistence."""

import math
import random
import tempfile

import numpy as np
from pyspark.sql import functions as F

from churnkit.operators import newton

FEATURES = ["a", "b", "k0"]
SCHEMA = "id long, a double, b double, k0 double, y int, fold int"


def rows(n=300, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b = r.gauss(0, 1), float(r.randrange(3))
        out.append((i, a, b, 1.0, int(a - 0.7 * b + r.gauss(0, 1) > 0.3), i % 4))
    return out


def objective(w, data):
    """Value and gradient by loops, weights n / (2 n_class)."""
    n = [sum(1 for r in data if r[4] == y) for y in (0, 1)]
    value, grad = sum(v * v for v in w) / 2, list(w)
    for r in data:
        x, y = [1.0, *r[1:4]], r[4]
        z, each = sum(a * b for a, b in zip(w, x)), len(data) / (2 * n[y])
        value += each * math.log1p(math.exp(-z if y else z))
        for j, v in enumerate(x):
            grad[j] += each * (1 / (1 + math.exp(-z)) - y) * v
    return value, grad


def test_gradient_is_zero_by_plain_loops_and_objective_falls(spark):
    data = rows()
    sets = {"f0": F.col("fold") != 0, "all": F.lit(True)}
    fits = newton.fit_many(spark.createDataFrame(data, SCHEMA).repartition(5), FEATURES, "y", sets)
    for name, mine in (("f0", [r for r in data if r[5] != 0]), ("all", data)):
        m = fits[name]
        value, grad = objective([m.intercept, *m.coefficients], mine)
        assert max(abs(g) for g in grad) < 1e-6 and abs(value - m.objective) < 1e-9
        falls = [t[2] for t in m.trace]
        assert all(b <= a * (1 + newton.ROUNDING) for a, b in zip(falls, falls[1:])) and m.steps == len(falls) - 1
    alone = newton.fit_many(spark.createDataFrame([r for r in data if r[5] != 0], SCHEMA), FEATURES, "y", {"f0": F.lit(True)})["f0"]
    assert np.allclose(alone.coefficients, fits["f0"].coefficients, atol=1e-9)


def test_separable_and_far_values_converge(spark):
    data = [(i, float(i) * 1e3, 0.0, 1.0, int(i > 5), 0) for i in range(12)]
    m = newton.fit_many(spark.createDataFrame(data, SCHEMA), FEATURES, "y", {"s": F.lit(True)})["s"]
    assert all(math.isfinite(v) for v in m.coefficients) and all(b[2] <= a[2] * (1 + newton.ROUNDING) for a, b in zip(m.trace, m.trace[1:])) and m.steps < 60
    _, grad = objective([m.intercept, *m.coefficients], data)
    assert max(abs(g) for g in grad) < 1e-6


def test_empty_sets_one_class_nulls_and_unlabelled_rows(spark):
    data = [(1, None, 1.0, 1.0, 1, 0), (2, float("nan"), 0.0, 1.0, 0, 0), (3, float("inf"), 2.0, None, 1, 1), (4, 5.0, 5.0, 5.0, None, 0)]
    clean = [(1, 0.0, 1.0, 1.0, 1, 0), (2, 0.0, 0.0, 1.0, 0, 0), (3, 0.0, 2.0, 0.0, 1, 1)]
    df = spark.createDataFrame(data, SCHEMA)
    sets = {"all": F.lit(True), "none": F.col("fold") > 7, "ones": F.col("fold") == 1, "null": F.lit(None).cast("boolean")}
    fits = newton.fit_many(df, FEATURES, "y", sets)
    same = newton.fit_many(spark.createDataFrame(clean, SCHEMA), FEATURES, "y", {"all": F.lit(True)})["all"]
    assert np.allclose(fits["all"].coefficients, same.coefficients)
    assert fits["none"].coefficients == [0.0] * 3 == fits["null"].coefficients
    assert fits["ones"].intercept > 0
    got = {r["id"]: r["p"] for r in newton.predict(df, {0: fits["all"]}, ["id"], by="fold").collect()}
    assert got[3] is None and all(0 < got[i] < 1 for i in (1, 2, 4))
    empty = newton.fit_many(df.limit(0), FEATURES, "y", {"all": F.lit(True)})["all"]
    assert empty.coefficients == [0.0] * 3 and empty.intercept == 0.0


def test_save_and_load(spark):
    m = newton.fit_many(spark.createDataFrame(rows(60), SCHEMA), FEATURES, "y", {"s": F.lit(True)})["s"]
    path = tempfile.mkdtemp(prefix="churnkit-newton-", dir="/tmp") + "/m"
    m.save(spark, path)
    back = newton.LogisticModel.load(spark, path)
    assert back.coefficients == m.coefficients and back.intercept == m.intercept and back.gradient == m.gradient
