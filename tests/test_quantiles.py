"""Exact bounded-state quantiles against numpy / nearest-rank definitions."""

import math
import random

import numpy as np

from churnkit.operators.quantiles import exact_quantiles


def test_matches_linear_and_disc(spark):
    rnd = random.Random(2)
    vals = [round(rnd.gauss(0, 1), 3) for _ in range(2000)] + [0.5] * 700  # a hot value
    rows = [(i % 3, v) for i, v in enumerate(vals)] + [(0, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.03, 0.25, 0.5, 0.75, 0.97, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"], accuracy=200).collect()}
    for g in range(3):
        arr = np.array(sorted(v for i, v in enumerate(vals) if i % 3 == g))
        for p in probs:
            assert abs(got[(g, p)] - float(np.quantile(arr, p))) < 1e-12
    disc = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "v", [0.05, 0.5, 0.95], method="disc").collect()}
    allv = sorted(vals)
    for p in (0.05, 0.5, 0.95):
        assert disc[p] == allv[max(0, math.ceil(p * len(allv)) - 1)]


def test_empty_and_all_null(spark):
    from churnkit.operators import profile
    df = spark.createDataFrame([(1, None), (2, None)], "k long, v double")
    assert exact_quantiles(df, "v", [0.5]).count() == 0
    d = profile.describe(df, ["v"]).first()
    assert d["count"] == 0 and d["p50"] is None and d["mean"] is None
    empty = spark.createDataFrame([], "k long, v double")
    assert exact_quantiles(empty, "v", [0.25, 0.75], ["k"]).count() == 0
