"""Outlier scores and their reports.

Two scores feed the same reporting operators:

* ``centroid_distance`` — distance from the mean in standardised space, a
  pure expression (deterministic, SQL-checkable);
* ``isolation_forest`` — trees grown on bounded samples (<= 256 rows per tree)
  in ``applyInPandas`` grouped by tree id, then every row is scored in
  ``mapInPandas`` against the broadcast node table (trees x <= 511 nodes).
  The table itself never leaves the executors.

Reported anomaly score = score - cut, where cut is the (1 - contamination)
quantile: > 0 means flagged (label -1), the reference's orientation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.decision import deviation_band, pct_deviation


# ------------------------------------------------------------------ scores

def centroid_distance(cols: Sequence[str]) -> Column:
    """sqrt(sum x_j^2) over already standardised columns."""
    return F.sqrt(sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0])))


def contamination_cut(df: DataFrame, score: str, contamination: float = 0.03, exact: bool = True) -> float:
    """O3: the (1 - contamination) quantile of the score (one scalar)."""
    q = 1.0 - contamination
    if exact:
        from churnkit.operators.quantiles import exact_quantiles
        return exact_quantiles(df, score, [q]).first()["quantile"]
    return df.agg(F.percentile_approx(score, q, 100000)).first()[0]


def flag_outliers(df: DataFrame, score: str, cut: float, out_score: str = "anomaly_score",
                  out_label: str = "outlier") -> DataFrame:
    """Anomaly score = score - cut (> 0 flagged), label -1 / 1."""
    s = F.col(score) - F.lit(float(cut))
    return df.withColumns({out_score: s, out_label: F.when(s > 0, -1).otherwise(1)})


# ------------------------------------------------------------------ reports

def top_anomalies(df: DataFrame, score: str, key: str, k: int = 100) -> DataFrame:
    """The k highest scores, ties by key."""
    return df.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)


def anomaly_feature_profile(df: DataFrame, top: DataFrame, features: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """Global mean vs top-k mean per feature, % difference (NULL when the
    global mean is ~0, fixing D3) and the plain difference."""
    g = df.agg(*[F.avg(c).alias(f"g{i}") for i, c in enumerate(features)])
    t = top.agg(*[F.avg(c).alias(f"t{i}") for i, c in enumerate(features)])
    g_long = g.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"g{i}").alias("global_mean"))
                                         for i, c in enumerate(features)])))
    t_long = t.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"t{i}").alias("anomaly_mean"))
                                         for i, c in enumerate(features)])))
    j = g_long.join(t_long, "feature")  # d rows each
    return j.select("feature", "global_mean", "anomaly_mean",
                    (F.col("anomaly_mean") - F.col("global_mean")).alias("difference"),
                    pct_deviation("anomaly_mean", "global_mean", eps).alias("pct_difference"))


def anomalies_per_cluster(top: DataFrame, cluster_cols: Sequence[str]) -> DataFrame:
    """For each clustering column, number of top anomalies per cluster."""
    long = top.select(*[F.col(c).cast("int").alias(c) for c in cluster_cols]).unpivot(
        [], list(cluster_cols), "method", "cluster")
    return long.groupBy("method", "cluster").agg(F.count(F.lit(1)).alias("n_anomalies"))


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t.

    With t = sqrt(dof) tan(a) the density becomes cos(x)^(dof - 1): the tail beyond
    a is integrated panel by panel (in logs, so p may be as small as a double
    can be) and divided by the integral over the half circle.
    """
    import numpy as np

    if t is None or dof <= 0:
        return float("nan")
    a, end = math.atan(abs(t) / math.sqrt(dof)), math.pi / 2
    whole = 0.5 * math.log(math.pi) + math.lgamma(dof / 2) - math.lgamma((dof + 1) / 2) - math.log(2)
    x, w = np.polynomial.legendre.leggauss(64)
    top = (dof - 1) * math.log(math.cos(a)) if a < end else 0.0
    total, width = 0.0, min(end - a, 2 / math.sqrt(dof))
    while a < end:
        b = min(end, a + width)
        points = a + (b - a) * (x + 1) / 2
        part = float((w * np.exp((dof - 1) * np.log(np.cos(points)) - top)).sum()) * (b - a) / 2
        total, a = total + part, b
        if part <= 1e-17 * total:
            break
    return min(1.0, math.exp(math.log(total) + top - whole)) if total > 0 else 0.0


def point_biserial(df: DataFrame, label: str, score: str) -> DataFrame:
    """r = Pearson(label, score), n and t = r sqrt((n-2)/(1-r^2)), in Spark."""
    agg = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).agg(
        F.corr(F.col(label).cast("double"), F.col(score)).alias("r"), F.count(F.lit(1)).alias("n"))
    r, n = F.col("r"), F.col("n")
    return agg.select("r", "n", (r * F.sqrt(F.try_divide(n - 2, 1 - r * r))).alias("t"))


def point_biserial_p(df: DataFrame, label: str, score: str) -> DataFrame:
    """A28 with the two-sided p-value (computed on the driver from two scalars)."""
    row = point_biserial(df, label, score).first()
    p = t_two_sided_p(row["t"], row["n"] - 2) if row["t"] is not None else None
    return df.sparkSession.createDataFrame([(row["r"], row["n"], row["t"], p)],
                                           "r double, n long, t double, p_value double")


def anomaly_kpis(df: DataFrame, flag: Column, label: str, positive=1) -> DataFrame:
    """Rows in scope, visible anomalies, their churn rate and its delta to
    the scope's overall rate (one aggregate)."""
    y = F.when(F.col(label) == positive, 1.0).otherwise(0.0)
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(flag, 1)).alias("n_anomalies"),
                 (F.avg(F.when(flag, y)) * 100.0).alias("anomaly_churn_rate"), (F.avg(y) * 100.0).alias("churn_rate"))
    return agg.withColumn("delta_pp", F.col("anomaly_churn_rate") - F.col("churn_rate"))


def quadrants(df: DataFrame, x: str, y: str) -> DataFrame:
    """Medians of both axes (one aggregate, two scalars) and the count of
    rows in each quadrant (>= median is 'high')."""
    from churnkit.operators.quantiles import exact_quantiles
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    long = both.select(F.col(x).cast("double").alias("mx"), F.col(y).cast("double").alias("my")).unpivot(
        [], ["mx", "my"], "_axis", "_v")
    med = {r["_axis"]: r["quantile"] for r in exact_quantiles(long, "_v", [0.5], ["_axis"]).collect()}
    hx = F.when(F.col(x) >= F.lit(med["mx"]), "high").otherwise("low")
    hy = F.when(F.col(y) >= F.lit(med["my"]), "high").otherwise("low")
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(hx.alias(f"{x}_side"), hy.alias(f"{y}_side")).agg(F.count(F.lit(1)).alias("n"))
            .withColumns({f"{x}_median": F.lit(med["mx"]), f"{y}_median": F.lit(med["my"])}))


def explain_rows(rows: DataFrame, df: DataFrame, key: str, features: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """Per selected row and feature, % deviation from the global mean and its
    colour band (all selected rows at once, long form)."""
    g = df.agg(*[F.avg(c).alias(f"g{i}") for i, c in enumerate(features)]).first()
    structs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                        F.lit(g[f"g{i}"]).alias("global_mean")) for i, c in enumerate(features)]
    long = rows.select(key, F.inline(F.array(*structs)))
    pct = pct_deviation("value", "global_mean", eps)
    return long.withColumns({"pct_deviation": pct, "band": deviation_band(F.coalesce(pct, F.lit(0.0)))})


# ------------------------------------------------------------------ isolation forest (O1)

def _avg_path(n):
    import numpy as np
    n = np.asarray(n, dtype=float)
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + 0.5772156649015329) - 2.0 * (n - 1.0) / np.maximum(n, 1.0),
                   np.where(n == 2, 1.0, 0.0))
    return out


def isolation_forest(df: DataFrame, key: str, features: Sequence[str], n_trees: int = 100, max_samples: int = 256,
                     seed: int = 42, out: str = "iso_score", keep: Sequence[str] = ()) -> DataFrame:
    """O1: isolation-forest score s = 2^(-E[h(x)] / c(max_samples)) per row, next to ``key`` and ``keep``.

    Samples: row r belongs to tree t's candidate pool when a seeded hash of
    (key, t) falls below ~4 x max_samples / n; the ``max_samples`` smallest
    hashes of the pool form the tree's sample.  Only pools are exploded, so
    the extra rows are bounded by trees x 4 x max_samples.
    """
    import numpy as np
    import pandas as pd

    from churnkit.session import ship_package
    ship_package(df.sparkSession)
    feats = list(features)
    n = df.count()
    m = min(max_samples, n)
    frac = min(1.0, 4.0 * m / max(n, 1))
    h = lambda t: F.xxhash64(F.col(key), F.lit(seed), t)  # noqa: E731  all 64 bits: no smallest share
    cut = min(2**63 - 1, int(frac * 2**64) - 2**63)
    pools = df.select(key, *feats, F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")) \
        if frac >= 1.0 else \
        df.select(key, *feats, F.explode(F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                                                  lambda t: h(t) < F.lit(cut))).alias("tree"))
    from pyspark.sql.window import Window
    w = Window.partitionBy("tree").orderBy(F.xxhash64(F.col(key), F.lit(seed), F.col("tree")), F.col(key))
    sample = pools.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= m).drop("_r")
    height_limit = int(math.ceil(math.log2(max(m, 2))))
    node_schema = ("tree int, node int, feature int, threshold double, left int, right int, size long, "
                   "depth int")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 1_000_003 + tree)
        x = pdf[feats].to_numpy(dtype=float)
        rows = []

        def build(idx, depth):
            node = len(rows)
            rows.append(None)
            sub = x[idx]
            if depth >= height_limit or len(idx) <= 1:
                rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx), depth)
                return node
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx), depth)
                return node
            f = int(rng.choice(cand))
            thr = float(rng.uniform(lo[f], hi[f]))
            left_idx, right_idx = idx[sub[:, f] < thr], idx[sub[:, f] >= thr]
            left = build(left_idx, depth + 1)
            right = build(right_idx, depth + 1)
            rows[node] = (tree, node, f, thr, left, right, len(idx), depth)
            return node

        build(np.arange(len(x)), 0)
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])

    nodes = sample.groupBy("tree").applyInPandas(grow, node_schema)
    # bounded: n_trees x (2 * max_samples - 1) nodes
    node_table = nodes.toPandas().sort_values(["tree", "node"])
    bc = df.sparkSession.sparkContext.broadcast(node_table)
    c_m = float(_avg_path([m])[0])

    def score(batches):
        nt = bc.value
        trees = [g.reset_index(drop=True) for _, g in nt.groupby("tree")]
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            total = np.zeros(len(x))
            for g in trees:
                feat, thr = g["feature"].to_numpy(), g["threshold"].to_numpy()
                left, right = g["left"].to_numpy(), g["right"].to_numpy()
                size, depth = g["size"].to_numpy(), g["depth"].to_numpy()
                cur = np.zeros(len(x), dtype=int)
                active = feat[cur] >= 0
                while active.any():
                    ia = np.flatnonzero(active)
                    go_left = x[ia, feat[cur[ia]]] < thr[cur[ia]]
                    cur[ia] = np.where(go_left, left[cur[ia]], right[cur[ia]])
                    active = feat[cur] >= 0
                total += depth[cur] + _avg_path(size[cur])
            yield pd.DataFrame({**{c: pdf[c] for c in cols}, out: np.power(2.0, -(total / len(trees)) / c_m)})

    cols = [key, *keep]
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)
    return df.select(*dict.fromkeys([*cols, *feats])).mapInPandas(score, f"{types}, {out} double")
