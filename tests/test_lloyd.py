"""Batched k-means: rounds against plain loops, silhouette against its definition, edge cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from churnkit.operators import lloyd

SCHEMA = "id long, v array<double>"


def rows(n=90, seed=4):
    r = random.Random(seed)
    return [(i, [r.gauss(8 * (i % 3), 1), r.gauss(5 * (i % 2), 1) + 100]) for i in range(n)]


def sq(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(v, centres):
    return min(range(len(centres)), key=lambda c: (sq(v, centres[c]), c))


def plain(data, k, start, rounds):
    centres = [v for _, v in sorted(data, key=lambda r: (hashlib.md5(f"{r[0]}|{start}".encode()).hexdigest(), r[0]))[:k]]
    for _ in range(rounds):
        groups = [[v for _, v in data if nearest(v, centres) == c] for c in range(len(centres))]
        centres = [[sum(x) / len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    return centres


def test_rounds_equal_plain_loops(spark):
    data = rows()
    runs = lloyd.fit_many(spark.createDataFrame(data, SCHEMA).repartition(4), "v", "id", (2, 3), (0, 1), rounds=3, tol=0.0)
    assert [(m.k, m.start) for m in runs] == [(2, 0), (2, 1), (3, 0), (3, 1)]
    for m in runs:
        centres = plain(data, m.k, m.start, 3)
        assert np.allclose(m.centres, centres)
        assert abs(m.cost - sum(min(sq(v, c) for c in centres) for _, v in data)) < 1e-6


def test_silhouette_by_pairs_and_planted_clusters(spark):
    data = rows()
    runs = lloyd.fit_many(spark.createDataFrame(data, SCHEMA), "v", "id", range(2, 8), range(6))
    m = lloyd.best_run(runs, 6)
    label = [nearest(v, m.centres.tolist()) for _, v in data]
    total = 0.0
    for i, (_, v) in enumerate(data):
        away = {c: [sq(v, w) for j, (_, w) in enumerate(data) if label[j] == c and j != i] for c in set(label)}
        if away[label[i]]:
            a, b = (sum(away[label[i]]) / len(away[label[i]]), min(sum(x) / len(x) for c, x in away.items() if c != label[i]))
            total += (b - a) / max(a, b)
    assert abs(total / len(data) - m.silhouette) < 1e-9
    table = {r["k"]: r["silhouette"] for r in lloyd.sweep_table(spark.range(1), runs).collect()}
    assert max(table, key=table.get) == 6


def test_ties_repeated_rows_nulls_few_rows_and_empty(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)]
    bad = [(7, None), (8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0])]
    runs = lloyd.fit_many(spark.createDataFrame(same + bad, SCHEMA), "v", "id", (2, 9), (0,))
    assert [len(m.centres) for m in runs] == [2, 5] and all(m.cost == 0 and m.silhouette is None for m in runs)
    assert runs[0].sizes.tolist() == [5, 0]
    assert lloyd.fit_many(spark.createDataFrame(bad, SCHEMA), "v", "id", (2,), (0,)) == []


def test_a_round_screens_all_runs_at_once(monkeypatch):
    """Moments of many runs against plain sums, ties to the first centre; no run has products of its own (before: each had)."""
    monkeypatch.setattr(lloyd, "_nearest", None)
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (1300, 3)).astype(float)
    at = {4: x[:3].copy(), 1: np.array([[0.0, 0, 0], [0, 0, 0], [9, 9, 9]]), 7: x[5:7] + 0.5}
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 3, dtype=np.int32)), pa.array(x.ravel()))
    out = {b.column("run")[0].as_py(): b.column("value").to_numpy().reshape(-1, 6)
           for b in lloyd._moments(at, np.zeros(3))([pa.RecordBatch.from_arrays([flat], names=["_x"])])}
    assert set(out) == set(at)
    for r, centres in at.items():
        away = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        label = np.array([min(range(len(centres)), key=lambda c: (row[c], c)) for row in away])
        for c in range(len(centres)):
            mine = x[label == c]
            want = [away[label == c, c].sum(), len(mine), (mine ** 2).sum(), *mine.sum(axis=0)]
            assert np.allclose(out[r][c], want)
    assert out[1][1][1] == 0  # the second of two equal centres gets no row
