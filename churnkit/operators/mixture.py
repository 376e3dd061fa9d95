"""Gaussian mixtures with full covariance for many numbers of components at once.

Every mixture starts where Spark ML's estimator starts (its fit of no iteration).  A round of expectation and
maximisation is then one Spark job for all mixtures: every task adds up weight, vector sum and sum of products by
component over its Arrow batches, Spark sums them by (mixture, entry), and the driver makes the new components.
Mixtures that have ended take no part in later rounds, so a sweep costs as many jobs as its slowest fit has rounds.
What is shuffled and collected is bounded by the sum of all k x dimensions^2 and does not grow with the rows.

The rules are Spark ML's: densities have the floor of the machine's precision, eigenvalues at its level are left out of the
inverse, a fit ends when the log-likelihood moves by at most ``tol``, and a row goes to its likeliest component
(the first of equals).  Eigenvalues of a singular covariance are rounding errors in both, so such fits may differ.  Every round
reads ``df``: pass a written table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.operators.lloyd import _collect, _entries, _points, silhouette_sum
from churnkit.session import ship_package

_FLOOR = float(np.finfo(float).eps)
#: Rows that a task works on at once.
_ROWS = 1024


@dataclass
class Mixture:
    """One mixture: weights (k), means (k, d; from ``origin``), covariances (k, d, d), and the silhouette of its labels."""

    k: int
    origin: np.ndarray
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    loglik: float = -np.inf
    rounds: int = 0
    silhouette: float | None = None

    def form(self) -> _Form:
        return _Form(self.weights, self.means, self.covs)


class _Form:
    """The components as one product: rows times ``roots`` less ``shift``, squared and added up by component."""

    def __init__(self, weights: np.ndarray, means: np.ndarray, covs: np.ndarray):
        k, d = means.shape
        self.k, self.d, self.weights = k, d, weights
        values, vectors = np.linalg.eigh(covs)
        least = _FLOOR * values.max(axis=1, keepdims=True) * d
        some = values > least
        safe = np.where(some, values, 1.0)
        self.constant = -0.5 * (d * np.log(2 * np.pi) + np.log(safe).sum(axis=1))
        roots = vectors * np.where(some, 1 / np.sqrt(safe), 0.0)[:, None, :]  # (k, d, d): columns are scaled eigenvectors
        self.roots = np.concatenate(list(roots), axis=1)
        self.shift = np.einsum("kd,kde->ke", means, roots).ravel()

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Density of every row in every component, times its weight."""
        z = x @ self.roots
        z -= self.shift
        away = np.einsum("nkd,nkd->nk", *[z.reshape(len(x), self.k, self.d)] * 2)
        return _FLOOR + self.weights * np.exp(self.constant - 0.5 * away)


def _upper(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d)


def _blocks(batches, origin: np.ndarray):
    for b in batches:
        x = _points(b, origin)
        for at in range(0, len(x), _ROWS):
            yield x[at:at + _ROWS]


def _expectation(at: dict[int, _Form], origin: np.ndarray):
    """Task: per mixture the log-likelihood, and per component its weight, vector sum and sum of products."""
    def run(batches):
        d = len(origin)
        every = np.ones((_ROWS, 1 + d + d * (d + 1) // 2))
        total = {r: np.zeros((f.k + 1, every.shape[1])) for r, f in at.items()}
        for x in _blocks(batches, origin):
            cells, end = every[:len(x)], 1 + d
            cells[:, 1:end] = x
            for j in range(d):  # products in the order of ``_upper``
                np.multiply(x[:, j:j + 1], x[:, j:], out=cells[:, end:end + d - j])
                end += d - j
            for r, f in at.items():
                p = f.shares(x)
                whole = p.sum(axis=1, keepdims=True)
                total[r][-1, 0] += np.log(whole).sum()
                total[r][:-1] += (p / whole).T @ cells
        yield from _entries(total)
    return run


def _label_sums(at: dict[int, _Form], origin: np.ndarray):
    """Task: per mixture and label the number of rows, the sum of squared norms and the vector sum."""
    def run(batches):
        total = {r: np.zeros((f.k, 2 + len(origin))) for r, f in at.items()}
        for x in _blocks(batches, origin):
            cells = np.concatenate([np.ones((len(x), 1)), (x ** 2).sum(axis=1, keepdims=True), x], axis=1)
            for r, f in at.items():
                label = f.shares(x).argmax(axis=1)
                total[r] += (label[:, None] == np.arange(f.k)[None, :]).T.astype(float) @ cells
        yield from _entries(total)
    return run


def _label_silhouettes(at: dict[int, _Form], sums: dict[int, np.ndarray], origin: np.ndarray):
    """Task: per mixture the sum of all silhouettes and the number of rows."""
    def run(batches):
        total = {r: np.zeros(2) for r in at}
        for x in _blocks(batches, origin):
            for r, f in at.items():
                m = sums[r]
                total[r] += silhouette_sum(x, f.shares(x).argmax(axis=1), m[:, 0], m[:, 1], m[:, 2:]), len(x)
        yield from _entries(total)
    return run


def _start(df: DataFrame, vec: str, k: int, seed: int, origin: np.ndarray) -> Mixture:
    """The components that Spark ML's estimator starts from."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    model = GaussianMixture(k=k, seed=seed, featuresCol="features", maxIter=0).fit(df.select(array_to_vector(vec).alias("features")))
    parts = model.gaussiansDF.collect()  # k rows
    return Mixture(k, origin, np.array(model.weights, float), np.array([g["mean"].toArray() for g in parts]) - origin,
                   np.array([g["cov"].toArray() for g in parts]))


def _step(m: Mixture, sums: np.ndarray) -> float:
    """Move the components to the sums; returns by how much the log-likelihood moved."""
    d = len(m.origin)
    weight, loglik, before = sums[:-1, 0], float(sums[-1, 0]), m.loglik
    m.means = sums[:-1, 1:1 + d] / weight[:, None]
    i, j = _upper(d)
    products = np.zeros((m.k, d, d))
    products[:, i, j] = products[:, j, i] = sums[:-1, 1 + d:]
    m.covs = products / weight[:, None, None] - m.means[:, :, None] * m.means[:, None, :]
    m.weights, m.loglik, m.rounds = weight / weight.sum(), loglik, m.rounds + 1
    return abs(loglik - before)


def fit_many(df: DataFrame, vec: str, ks: Sequence[int], seed: int = 42, rounds: int = 100, tol: float = 0.01) -> list[Mixture]:
    """A mixture for every k, with the silhouette (squared Euclidean) of its labels; None if all rows have one label."""
    ship_package(df.sparkSession)
    points = df.select(F.col(vec).cast("array<double>").alias("_x"))
    first = points.first()
    if first is None:
        raise ValueError("a mixture needs rows")
    dim = len(first["_x"])
    origin = np.array(points.agg(*[F.avg(F.col("_x")[i]) for i in range(dim)]).first(), float)
    from churnkit.operators.segments import parallel_map

    fits = parallel_map(lambda k: _start(df, vec, k, seed, origin), list(ks))
    going = set(range(len(fits)))
    for _ in range(rounds):
        if not going:
            break
        at = {r: fits[r].form() for r in going}
        for r, sums in _collect(points, _expectation(at, origin), {r: (f.k + 1, 1 + dim + dim * (dim + 1) // 2) for r, f in at.items()}).items():
            if _step(fits[r], sums) <= tol:
                going.discard(r)
    at = {r: m.form() for r, m in enumerate(fits)}
    sums = _collect(points, _label_sums(at, origin), {r: (f.k, 2 + dim) for r, f in at.items()})
    at = {r: f for r, f in at.items() if (sums[r][:, 0] > 0).sum() > 1}
    if at:
        for r, (total, n) in _collect(points, _label_silhouettes(at, {r: sums[r] for r in at}, origin), {r: (2,) for r in at}).items():
            fits[r].silhouette = float(total / n)
    return fits


def assign(df: DataFrame, vec: str, model: Mixture, out: str) -> DataFrame:
    """``df`` with the likeliest component of every row."""
    ship_package(df.sparkSession)
    form, origin, names = model.form(), model.origin, df.columns

    def run(batches):
        for b in batches:
            x = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(origin)) - origin
            label = [form.shares(x[at:at + _ROWS]).argmax(axis=1) for at in range(0, len(x), _ROWS)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(np.concatenate([np.zeros(0, int), *label]), pa.int32())], names=[*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` int"
    return df.withColumn("_x", F.col(vec).cast("array<double>")).mapInArrow(run, schema)


def chosen(fits: Sequence[Mixture]) -> Mixture:
    """The mixture of highest silhouette (first maximum in order of k; those without one last)."""
    return max(sorted(fits, key=lambda m: m.k), key=lambda m: -2.0 if m.silhouette is None else m.silhouette)


def sweep_table(df: DataFrame, fits: Sequence[Mixture]) -> DataFrame:
    """(method, k, silhouette) of every mixture."""
    return df.sparkSession.createDataFrame([("gmm", m.k, m.silhouette) for m in fits], "method string, k int, silhouette double")
