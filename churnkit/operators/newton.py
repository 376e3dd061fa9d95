"""Class-weighted logistic regression by Newton steps, many training sets at once.

The objective is ``|w|^2 / 2 + C * sum(weight * log(1 + exp(-y * w.x)))`` with the intercept among
the penalised coefficients.  A step is one Spark job for all training sets (cross-validation folds
and refits): every task adds up loss, gradient ``X'(p - y)`` and Hessian ``X'WX`` of each set over
its Arrow batches, Spark sums them by (set, entry), and the driver solves one small system per set.
What is shuffled and collected is bounded by sets x features^2 and does not grow with the rows.

Every step reads ``data`` again, so pass a written table.  NULL and non-finite features count as 0;
rows without a label are in no set; a set without rows has coefficients 0.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.clean import finite_or_zero
from churnkit.functions.decision import sigmoid
from churnkit.operators.scoring import LinearScorer
from churnkit.session import ship_package

#: A fit ends when the Newton decrement is at most this; no coefficient would then move further in the next step.
TOLERANCE = 1e-9
#: A step whose objective is above the last one by more than this share (rounding of long sums) is halved.
ROUNDING = 1e-12


@dataclass
class LogisticModel:
    """A fitted model: coefficients by feature, the objective and largest gradient entry at them, the steps taken."""

    features: list[str]
    coefficients: list[float]
    intercept: float
    objective: float = 0.0
    gradient: float = 0.0
    steps: int = 0
    trace: list = field(default_factory=list)  # (step, intercept and coefficients, objective, gradient)

    def prob(self):
        """Positive-class probability as an expression."""
        scorer = LinearScorer("lr", self.intercept, dict(zip(self.features, self.coefficients)))
        return scorer.prob_with({f: finite_or_zero(f) for f in self.features})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(vars(self)),)], "about string").coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LogisticModel":
        return cls(**json.loads(spark.read.json(path).first()["about"]))


def _sums(features: int, weights: np.ndarray, at: dict[int, np.ndarray]):
    """Task: (set, entry, value) sums of loss, gradient and upper Hessian of each set in ``at`` at its coefficients."""
    upper = np.triu_indices(features + 1)

    def run(batches):
        total = {s: np.zeros(1 + features + 1 + len(upper[0])) for s in at}
        for b in batches:
            x = np.ones((b.num_rows, features + 1))
            for j in range(features):
                x[:, j + 1] = b.column(f"_f{j}").to_numpy(zero_copy_only=False)
            y = b.column("_y").to_numpy(zero_copy_only=False).astype(int)
            for s, w in at.items():
                mine = b.column(f"_s{s}").to_numpy(zero_copy_only=False).astype(bool)
                xs, ys = x[mine], y[mine]
                z, each = xs @ w, weights[s][ys]
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                total[s][0] += (each * np.logaddexp(0, np.where(ys > 0, -z, z))).sum()
                total[s][1:features + 2] += xs.T @ (each * (p - ys))
                total[s][features + 2:] += (xs.T @ (xs * (each * p * (1 - p))[:, None]))[upper]
        for s, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), s, np.int32)), pa.array(np.arange(len(t), dtype=np.int32)), pa.array(t)],
                                             names=["set", "entry", "value"])
    return run


def _evaluate(rows: DataFrame, features: int, weights: np.ndarray, at: dict[int, np.ndarray]) -> dict[int, tuple]:
    """Loss, gradient and Hessian of every set in ``at``: one job."""
    sums = rows.mapInArrow(_sums(features, weights, at), "set int, entry int, value double").groupBy("set", "entry").agg(F.sum("value").alias("value"))
    d = features + 1
    flat = {s: np.zeros(1 + d + d * (d + 1) // 2) for s in at}
    for r in sums.collect():  # sets x (features + 2)(features + 3) / 2 rows
        flat[r["set"]][r["entry"]] = r["value"]
    out, upper = {}, np.triu_indices(d)
    for s, t in flat.items():
        h = np.zeros((d, d))
        h[upper] = t[1 + d:]
        out[s] = t[0], t[1:1 + d], h + np.triu(h, 1).T
    return out


def fit_many(data: DataFrame, features: Sequence[str], label: str, sets: dict, c: float = 1.0, max_steps: int = 100) -> dict[str, LogisticModel]:
    """A model for every training set (name -> condition on ``data``'s rows), its classes weighted n / (2 n_class) (M3).

    A step that does not lower the objective is halved, so the objective falls from step to step.
    Sets that have converged take no part in later jobs; those that have not after ``max_steps`` warn.
    """
    ship_package(data.sparkSession)
    features, names, d = list(features), list(sets), len(features) + 1
    flags = [(F.coalesce(cond, F.lit(False)) & F.col(label).isNotNull()).alias(f"_s{i}") for i, cond in enumerate(sets.values())]
    rows = data.select(*[finite_or_zero(f).alias(f"_f{j}") for j, f in enumerate(features)],
                       F.col(label).cast("int").alias("_y"), *flags)
    any_set = F.lit(False)
    for i in range(len(names)):
        any_set = any_set | F.col(f"_s{i}")
    rows = rows.where(any_set)
    counts = rows.agg(*[F.coalesce(F.sum((F.col(f"_s{i}") & (F.col("_y") == y)).cast("long")), F.lit(0)).alias(f"n{i}_{y}")
                        for i in range(len(names)) for y in (0, 1)]).first()
    n = np.array([[counts[f"n{i}_{y}"] for y in (0, 1)] for i in range(len(names))], float)
    weights = c * n.sum(axis=1, keepdims=True) / (2 * np.maximum(n, 1))

    fits = {i: LogisticModel(features, [0.0] * len(features), 0.0) for i in range(len(names))}
    at = {i: np.zeros(d) for i in range(len(names)) if n[i].sum()}
    before: dict[int, tuple] = {}
    for _ in range(max_steps + 1):
        if not at:
            break
        for s, (loss, g, h) in _evaluate(rows, len(features), weights, at).items():
            w, m = at[s], fits[s]
            objective, g = loss + w @ w / 2, g + w
            if s in before and objective > before[s][1] * (1 + ROUNDING):
                at[s] = (w + before[s][0]) / 2
                continue
            m.intercept, m.coefficients = float(w[0]), [float(v) for v in w[1:]]
            m.objective, m.gradient, m.steps = float(objective), float(np.abs(g).max()), len(m.trace)
            m.trace.append((m.steps, [float(v) for v in w], m.objective, m.gradient))
            step = np.linalg.solve(h + np.eye(d), g)
            if g @ step <= TOLERANCE ** 2:
                del at[s]
            else:
                before[s], at[s] = (w, objective), w - step
    if at and max_steps >= 20:
        warnings.warn(f"logistic regression of {[names[s] for s in at]} has not converged after {max_steps} steps", stacklevel=2)
    return {name: fits[i] for i, name in enumerate(names)}


def predict(df: DataFrame, models: dict, keep: Sequence[str], by: str | None = None, out: str = "p") -> DataFrame:
    """``keep`` and the positive-class probability.  ``by`` names the column whose value picks the model (other values: NULL);
    without it ``models`` has one model, under None."""
    if by is None:
        return df.select(*keep, models[None].prob().alias(out))
    # one linear form whose coefficients are looked up by the row's model
    fits = list(models.values())
    at = F.array_position(F.array(*[F.lit(v) for v in models]), F.col(by)).cast("int") - 1
    z = F.get(F.array(*[F.lit(m.intercept) for m in fits]), at)
    for j, f in enumerate(fits[0].features):
        z = z + F.get(F.array(*[F.lit(m.coefficients[j]) for m in fits]), at) * finite_or_zero(f)
    return df.select(*keep, sigmoid(z).alias(out))


def step_table(spark: SparkSession, fits: dict[str, LogisticModel], steps: Sequence[int]) -> DataFrame:
    """set_name, step, feature, coefficient of the given steps (step 0 is the start at zero)."""
    rows = [(name, step, f, w[j]) for name, m in fits.items() for step, w, *_ in m.trace if step in steps
            for j, f in enumerate(["(intercept)", *m.features])]
    return spark.createDataFrame(rows, "set_name string, step int, feature string, coefficient double")
