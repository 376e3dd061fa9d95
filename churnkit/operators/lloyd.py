"""k-means for many numbers of clusters and many starts at once (C2, C5, C4 of the sweep).

A round is one Spark job for all (k, start) runs: every task assigns its rows to the nearest centre
of each run and adds up size, sum of squared norms and vector sum by cluster, Spark sums them by
(run, entry), and the driver moves the centres.  Runs that stand still take no part in later
rounds, so a sweep costs as many jobs as its slowest run has rounds.  The squared-Euclidean
silhouette of the best run of every k takes one more job, from the same sums.  What is shuffled and
collected is bounded by the sum of all k x dimensions and does not grow with the rows.

Start s of k clusters takes the first k rows by md5 of ``key|s``, so a fit depends on neither the partitioning
nor a random state.  Equal distances go to the lowest cluster, a cluster without rows
keeps its centre, and with fewer rows than k a run has as many clusters as rows.  Rows whose vector
is NULL or holds a NULL or non-finite entry are left out.  Every round reads ``df``: pass a written table.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.session import ship_package


@dataclass
class Run:
    """One run: its centres, cost (sum of squared distances) and cluster statistics at them."""

    k: int
    start: int
    centres: np.ndarray
    cost: float = 0.0
    rounds: int = 0
    sizes: np.ndarray | None = None
    norms: np.ndarray | None = None  # sums of squared norms, from the origin of the fit
    sums: np.ndarray | None = None
    silhouette: float | None = None

    def table(self) -> list[tuple]:
        """(cluster, centre) pairs for ``segments.assign_nearest``."""
        return [(i, c.tolist()) for i, c in enumerate(self.centres)]


#: Rows that a task works on at once.
_ROWS = 512


def _points(batch: pa.RecordBatch, origin: np.ndarray) -> np.ndarray:
    return batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(origin)) - origin


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every point."""
    d2 = (centres ** 2).sum(axis=1)[None, :] - 2 * x @ centres.T
    label = d2.argmin(axis=1)
    return label, np.maximum(0, d2[np.arange(len(x)), label] + (x ** 2).sum(axis=1))


def _entries(total: dict):
    for run, t in total.items():
        t = t.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), run, np.int32)), pa.array(np.arange(len(t), dtype=np.int32)), pa.array(t)],
                                         names=["run", "entry", "value"])


def _moments(at: dict[int, np.ndarray], origin: np.ndarray):
    """Task: per run and cluster (cost, size, sum of squared norms, vector sum).

    The centres of all runs are one product with a few rows at a time, which stay in the processor's cache."""
    runs = list(at)
    ends = np.cumsum([0, *[len(at[r]) for r in runs]])
    spans = list(zip(ends[:-1], ends[1:]))
    every = np.concatenate([at[r] for r in runs])
    factors = np.concatenate([(every ** 2).sum(axis=1, keepdims=True), -2 * every], axis=1)

    def run(batches):
        total = np.zeros((len(every), 3 + len(origin)))
        for b in batches:
            points = _points(b, origin)
            for i in range(0, len(points), _ROWS):
                x = points[i:i + _ROWS]
                xx = (x ** 2).sum(axis=1)
                away = factors @ np.concatenate([np.ones((len(x), 1)), x], axis=1).T  # squared distance less the row's squared norm
                mine = np.empty_like(away)  # 1 where a centre is its run's nearest
                for start, end in spans:
                    np.equal(away[start:end], away[start:end].min(axis=0), out=mine[start:end])
                    if mine[start:end].sum() != len(x):  # equal distances go to the first
                        mine[start:end] = np.arange(end - start)[:, None] == away[start:end].argmin(axis=0)
                total[:, 1:] += mine @ np.concatenate([np.ones((len(x), 1)), xx[:, None], x], axis=1)
                away += xx
                total[:, 0] += np.einsum("kn,kn->k", np.maximum(0, away, out=away), mine)
        yield from _entries({r: total[start:end] for r, (start, end) in zip(runs, spans)})
    return run


def silhouette_sum(x: np.ndarray, label: np.ndarray, sizes: np.ndarray, norms: np.ndarray, sums: np.ndarray) -> float:
    """Sum of the squared-Euclidean silhouettes of labelled rows, from every cluster's size, sum of squared norms and vector sum."""
    xx, i = (x ** 2).sum(axis=1), np.arange(len(x))
    away = sizes[None, :] * xx[:, None] - 2 * x @ sums.T + norms[None, :]  # squared distances to all rows of a cluster
    own, n = away[i, label], sizes[label]
    mean = np.where(sizes > 0, away / np.maximum(1, sizes), np.inf)
    mean[i, label] = np.inf
    a, other = own / np.maximum(1, n - 1), mean.min(axis=1)
    most = np.maximum(a, other)
    return np.where((n > 1) & (most > 0), (other - a) / np.where(most > 0, most, 1), 0.0).sum()


def _silhouettes(at: dict[int, Run], centres: dict[int, np.ndarray], origin: np.ndarray):
    """Task: per run the sum of all silhouettes and the number of rows."""
    def run(batches):
        total = {r: np.zeros(2) for r in at}
        for b in batches:
            x = _points(b, origin)
            for r, m in at.items():
                total[r] += silhouette_sum(x, _nearest(x, centres[r])[0], m.sizes, m.norms, m.sums), len(x)
        yield from _entries(total)
    return run


def _collect(points: DataFrame, task, shapes: dict[int, tuple]) -> dict[int, np.ndarray]:
    out = {r: np.zeros(int(np.prod(s))) for r, s in shapes.items()}
    sums = points.mapInArrow(task, "run int, entry int, value double").groupBy("run", "entry").agg(F.sum("value").alias("value"))
    for r in sums.collect():  # sum of all k x (dimensions + 3) rows
        out[r["run"]][r["entry"]] = r["value"]
    return {r: v.reshape(shapes[r]) for r, v in out.items()}


def starting_points(df: DataFrame, vec: str, key: str, most: int, starts: Sequence[int]) -> dict[int, np.ndarray]:
    """Per start the first ``most`` vectors by md5 of ``key|start`` (the window keeps ``most`` rows a start before its shuffle)."""
    named = df.select(F.col(key).alias("_key"), F.col(vec).alias("_x"), F.explode(F.array(*[F.lit(int(s)) for s in starts])).alias("_s"))
    order = Window.partitionBy("_s").orderBy(F.md5(F.concat_ws("|", F.col("_key").cast("string"), F.col("_s").cast("string")).cast("binary")), "_key")
    rows = named.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).collect()
    return {s: np.array([r["_x"] for r in sorted((r for r in rows if r["_s"] == s), key=lambda r: r["_r"])]) for s in starts}


def fit_many(df: DataFrame, vec: str, key: str, ks: Sequence[int], starts: Sequence[int], rounds: int = 300, tol: float = 1e-4) -> list[Run]:
    """A run for every k and start.  A run ends when its centres' squared moves add up to at most ``tol`` x the mean variance
    of the columns; runs that have not ended after ``rounds`` rounds warn (unless ``tol`` is 0, a fixed number of rounds)."""
    ship_package(df.sparkSession)
    good = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    df = df.where(good)
    first = starting_points(df, vec, key, max(ks), starts)
    dim = next((len(p[0]) for p in first.values() if len(p)), 0)
    if not dim:
        return []
    points = df.select(F.col(vec).cast("array<double>").alias("_x"))
    about = points.agg(*[F.avg(F.col("_x")[i]) for i in range(dim)], *[F.var_pop(F.col("_x")[i]) for i in range(dim)]).first()
    origin, still = np.array(about[:dim], float), tol * float(np.mean(about[dim:]))
    runs = [Run(k, s, first[s][:k] - origin) for k in ks for s in starts]
    going = set(range(len(runs)))
    shape = lambda r: (len(runs[r].centres), 3 + dim)
    for _ in range(rounds):
        if not going:
            break
        at = {r: runs[r].centres for r in going}
        for r, m in _collect(points, _moments(at, origin), {r: shape(r) for r in going}).items():
            new = np.where(m[:, 1:2] > 0, m[:, 3:] / np.maximum(1, m[:, 1:2]), runs[r].centres)
            moved = float(((new - runs[r].centres) ** 2).sum())
            runs[r].centres, runs[r].rounds = new, runs[r].rounds + 1
            if moved <= still:
                going.discard(r)
    if going and tol:
        warnings.warn(f"{len(going)} k-means runs had not ended after {rounds} rounds", stacklevel=2)
    last = _collect(points, _moments({r: m.centres for r, m in enumerate(runs)}, origin), {r: shape(r) for r in range(len(runs))})
    for r, m in last.items():
        runs[r].cost, runs[r].sizes, runs[r].norms, runs[r].sums = float(m[:, 0].sum()), m[:, 1], m[:, 2], m[:, 3:]
    best = {r: m for r, m in enumerate(runs) if m is best_run(runs, m.k) and (m.sizes > 0).sum() > 1}
    if best:
        of = _collect(points, _silhouettes(best, {r: m.centres for r, m in best.items()}, origin), {r: (2,) for r in best})
        for r, (total, n) in of.items():
            runs[r].silhouette = float(total / n)
    for m in runs:
        m.centres = m.centres + origin
    return runs


def best_run(runs: Sequence[Run], k: int) -> Run:
    """The run of lowest cost for k; of equal costs the first."""
    return min((m for m in runs if m.k == k), key=lambda m: m.cost)


def sweep_table(df: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """(method, k, silhouette) of the best run of every k."""
    ks = sorted({m.k for m in runs})
    return df.sparkSession.createDataFrame([("kmeans", k, best_run(runs, k).silhouette) for k in ks], "method string, k int, silhouette double")
