"""Exact quantiles with bounded per-task state.

Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer, so a global median over a continuous column would land in a single
task.  Here the exact answer comes in two bounded passes:

1. per group: the row count and a quantile sketch (``percentile_approx``,
   rank error <= n / accuracy) give a bracket [L, U] around each target rank;
2. per group: rows below L are counted; rows inside [L, U] are reduced to
   (value, count) pairs by partial aggregation — a value shared by a third of
   the table is one pair — and only those pairs are ranked.

The value at 0-based rank r is read off the cumulative pair counts; linear
interpolation between ranks floor(h) and ceil(h), h = (n - 1) p, matches the
pandas / DuckDB ``quantile_cont`` definition; ``method='disc'`` returns the
SQL PERCENTILE_DISC value (rank ceil(p n) - 1).  A bracket that holds more than
``MOST_INSIDE`` rows is narrowed by a sketch of its own rows, until it is that
small or a single value; a bracket that misses its rank (it should not, given the
sketch's guarantee) is widened and retried until it covers all values.  NULL
groups are groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.operators.ranking import join_null_safe
from churnkit.session import stored

ACCURACY = 100_000
MOST_INSIDE = 1_000_000


def _targets(n: int, p: float, method: str) -> tuple[int, int, float]:
    if method == "disc":
        r = max(0, min(n - 1, math.ceil(p * n) - 1))
        return r, r, 0.0
    h = (n - 1) * p
    lo, hi = math.floor(h), math.ceil(h)
    return lo, hi, h - lo


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                    method: str = "linear", accuracy: int = ACCURACY) -> DataFrame:
    """(by..., prob, quantile) for every group; NULL values ignored; empty group -> no row.

    Groups are reported rows (labels, features), so their count is small; the
    per-group bracket arrays travel as a small table (or literals without
    groups).  The passes read the one-column input from the shared folder.
    """
    keys = list(by)
    spark = df.sparkSession
    x = stored(spark, df.select(*keys, F.col(col).cast("double").alias("_x")).where(
        F.col("_x").isNotNull() & ~F.isnan("_x")), "quantiles")
    return _exact(spark, x, keys, [float(p) for p in probs], method, accuracy)


def _group_table(spark, x, keys, rows, cols):
    schema = ", ".join([f"`{k}` {x.schema[k].dataType.simpleString()}" for k in keys] + cols)
    return spark.createDataFrame(rows, schema)


def _bracketed(spark, x, keys, bounds, P):
    """(rows with their group's brackets, rows below each bracket, rows inside it)."""
    if keys:
        br = _group_table(spark, x, keys, [(*g, lo, hi) for g, (lo, hi) in bounds.items()],
                          ["_los array<double>", "_his array<double>"])
        xb = join_null_safe(x, br, keys)
    else:
        lo, hi = bounds[()]
        xb = x.withColumns({"_los": F.array(*[F.lit(v) for v in lo]), "_his": F.array(*[F.lit(v) for v in hi])})
    is_in = lambda i: (F.col("_x") >= F.col("_los")[i]) & (F.col("_x") <= F.col("_his")[i])
    rows = xb.groupBy(*keys).agg(*[F.count(F.when(F.col("_x") < F.col("_los")[i], 1)).alias(f"_b{i}") for i in range(P)],
                                 *[F.count(F.when(is_in(i), 1)).alias(f"_c{i}") for i in range(P)]).collect()
    of = lambda n: {(tuple(r[k] for k in keys), i): r[f"{n}{i}"] for r in rows for i in range(P)}
    return xb, of("_b"), of("_c")


def _narrow(xb, keys, bounds, below, inside_n, counts, pending, method, accuracy) -> bool:
    """Shrink every bracket to a sketch of its own rows around the target ranks; False if none could shrink."""
    P, shrunk = len(pending), False
    inside = lambda i: F.when((F.col("_x") >= F.col("_los")[i]) & (F.col("_x") <= F.col("_his")[i]), F.col("_x"))
    steps = [k / 1000 for k in range(1001)]
    rows = xb.groupBy(*keys).agg(*[F.percentile_approx(inside(i), steps, accuracy).alias(f"_q{i}") for i in range(P)]).collect()
    for r in rows:
        g = tuple(r[k] for k in keys)
        for i, p in enumerate(pending):
            n, q = inside_n[(g, i)], r[f"_q{i}"]
            if n <= MOST_INSIDE or not q:
                continue
            a, b, _ = _targets(counts[g], p, method)
            a, b = a - below[(g, i)], b - below[(g, i)]
            if not (0 <= a and b < n):
                continue  # the bracket missed its rank; it is widened later
            lo = float(q[max(0, int(a / n * 1000) - 2)])
            hi = float(q[min(1000, int(b / n * 1000) + 3)])
            if (lo, hi) != (bounds[g][0][i], bounds[g][1][i]):
                bounds[g][0][i], bounds[g][1][i] = lo, hi
                shrunk = True
    return shrunk


def _exact(spark, x, keys, probs, method, accuracy):
    eps = 1.0 / accuracy
    slack = {p: 3 * eps for p in probs}
    result: dict[tuple, dict[float, float]] = {}
    pending = list(probs)
    counts = None
    while pending:  # ends: a bracket that covers all values holds its rank
        P = len(pending)
        lo_ps = [max(0.0, p - slack[p]) for p in pending]
        hi_ps = [min(1.0, p + slack[p]) for p in pending]
        # pass 1: count + sketch per group (one row per group)
        sk = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                  F.percentile_approx("_x", lo_ps + hi_ps, accuracy).alias("_q")).collect()
        sk = [r for r in sk if r["_n"] and r["_q"] is not None]  # an empty group has no quantile
        if not sk:
            break
        counts = {tuple(r[k] for k in keys): r["_n"] for r in sk}
        bounds = {tuple(r[k] for k in keys): ([float(v) for v in r["_q"][:P]], [float(v) for v in r["_q"][P:]])
                  for r in sk}
        for p, i in ((p, i) for i, p in enumerate(pending) if slack[p] >= 1.0):
            for lo, hi in bounds.values():
                lo[i], hi[i] = float("-inf"), float("inf")
        # pass 2a: rows below and inside each bracket (wide aggregate, groups x P numbers to the driver)
        xb, below, inside_n = _bracketed(spark, x, keys, bounds, P)
        while any(n > MOST_INSIDE and bounds[g][0][i] < bounds[g][1][i] for (g, i), n in inside_n.items()):
            if not _narrow(xb, keys, bounds, below, inside_n, counts, pending, method, accuracy):
                break
            xb, below, inside_n = _bracketed(spark, x, keys, bounds, P)
        # pass 2b: (value, count) pairs inside each bracket, ranked; only rows at target ranks come back
        inside = F.filter(F.sequence(F.lit(0), F.lit(P - 1)),
                          lambda i: (F.col("_x") >= F.col("_los")[i]) & (F.col("_x") <= F.col("_his")[i]))
        pairs = (xb.select(*keys, "_x", F.explode(inside).alias("_i"))
                 .groupBy(*keys, "_i", "_x").agg(F.count(F.lit(1)).alias("_c")))
        tgt = []
        for g, n in counts.items():
            for i, p in enumerate(pending):
                r_lo, r_hi, _ = _targets(n, p, method)
                tgt.append((*g, i, r_lo - below[(g, i)], r_hi - below[(g, i)]))
        tg = _group_table(spark, x, keys, tgt, ["_i int", "_rlo long", "_rhi long"])
        w = Window.partitionBy(*keys, "_i").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
        ranked = pairs.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))
        hit = join_null_safe(ranked, tg, [*keys, "_i"]).where(
            ((F.col("_start") <= F.col("_rlo")) & (F.col("_rlo") < F.col("_end")))
            | ((F.col("_start") <= F.col("_rhi")) & (F.col("_rhi") < F.col("_end"))))
        found: dict[tuple, dict[int, float]] = {}
        for r in hit.select(*keys, "_i", "_x", "_start", "_end", "_rlo", "_rhi").collect():
            d = found.setdefault((tuple(r[k] for k in keys), r["_i"]), {})
            for rank in (r["_rlo"], r["_rhi"]):
                if r["_start"] <= rank < r["_end"]:
                    d[rank] = r["_x"]
        retry = []
        for i, p in enumerate(pending):
            ok = True
            for g, n in counts.items():
                r_lo, r_hi, _ = _targets(n, p, method)
                d = found.get((g, i), {})
                a, b = r_lo - below[(g, i)], r_hi - below[(g, i)]
                if a in d and b in d:
                    h = (n - 1) * p
                    v = d[a] if r_lo == r_hi else (r_hi - h) * d[a] + (h - r_lo) * d[b]
                    result.setdefault(g, {})[p] = v
                else:
                    ok = False
            if not ok:
                slack[p] *= 8
                retry.append(p)
        pending = retry
    rows = [(*g, float(p), float(v)) for g, d in result.items() for p, v in d.items()]
    return _group_table(spark, x, keys, rows, ["prob double", "quantile double"])
