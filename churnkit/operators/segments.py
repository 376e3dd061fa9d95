"""Segmentation (C1-C5, C9, C10) and cluster reporting.

Vectors are ``array<double>`` columns (or ML vectors for the estimators).
Cluster centres and per-cluster sums are bounded by k x d, so they travel
as literals inside expressions; every per-row computation stays JVM-side.
Silhouette uses the squared-Euclidean identity
``sum_y |x - y|^2 = n_C |x|^2 - 2 x . S_C + Q_C`` — linear in n, no pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions.decision import minmax_normalise


# ------------------------------------------------------------------ vector helpers

def as_array(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


#: The ten starts of each k-means fit.
SEEDS = tuple(range(42, 52))
#: Numbers of clusters of a sweep.
KS = tuple(range(2, 11))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def sq_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v)


def _lit_vec(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


# ------------------------------------------------------------------ centres and assignment

def group_centroids(df: DataFrame, vec: str, group: str) -> list[tuple]:
    """Mean vector per group (k rows to the driver), sorted by group."""
    dim = len(df.select(vec).first()[0])
    rows = (df.groupBy(group).agg(*[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(dim)])
            .orderBy(group).collect())
    return [(r[group], [r[f"m{i}"] for i in range(dim)]) for r in rows]


def assign_nearest(df: DataFrame, vec: str, centres: list[tuple], out: str = "cluster",
                   dist_out: str | None = "distance") -> DataFrame:
    """C2 assignment step: nearest centre by squared Euclidean distance (ties ->
    lowest centre id).  Centres are k x d literals — no join."""
    table = F.array(*[F.struct(_lit_vec(v).alias("v"), F.lit(cid).alias("id")) for cid, v in centres])
    d2 = F.transform(table, lambda c: F.struct(sq_dist(F.col(vec), c["v"]).alias("d"), c["id"].alias("id")))
    # inline_outer keeps the best (distance, id) as one generated row: each distance is computed once.
    best = df.select("*", F.inline(F.array(F.array_min(d2))).alias("_d2", "_id"))
    cols = [F.col("_id").alias(out)] + ([F.sqrt("_d2").alias(dist_out)] if dist_out else [])
    return best.select(*[c for c in df.columns if c not in (out, dist_out)], *cols)


# ------------------------------------------------------------------ silhouette

def cluster_sums(df: DataFrame, vec: str, cluster: str) -> list[tuple]:
    """Per cluster: size, vector sum and sum of squared norms (k rows)."""
    dim = len(df.select(vec).first()[0])
    rows = (df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.sum(sq_norm(F.col(vec))).alias("q"),
                                    *[F.sum(F.col(vec)[i]).alias(f"s{i}") for i in range(dim)])
            .orderBy(cluster).collect())
    return [(r[cluster], r["n"], r["q"], [r[f"s{i}"] for i in range(dim)]) for r in rows]


def silhouette_points(df: DataFrame, vec: str, cluster: str, noise: int | None = None) -> DataFrame:
    """Per-row squared-Euclidean silhouette s = (b - a) / max(a, b); singleton
    clusters give 0.  Rows of the ``noise`` cluster are excluded (C9)."""
    if noise is not None:
        df = df.where(F.col(cluster) != noise)
    # Distances don't change when the origin moves to the mean, and the identity then subtracts numbers of their own size.
    names = df.columns
    row = df.select(vec).first()
    if row is None:
        return df.withColumn("silhouette", F.lit(None).cast("double"))
    mean = df.agg(*[F.avg(F.col(vec)[i]) for i in range(len(row[0]))]).first()
    df = df.withColumn("_x", F.zip_with(F.col(vec), _lit_vec(mean), lambda a, b: a - b))
    stats = cluster_sums(df, "_x", cluster)
    x = F.col("_x")
    xx = sq_norm(x)
    own_a, others = None, []
    for cid, n, q, s in stats:
        total = F.lit(float(n)) * xx - 2.0 * dot(x, _lit_vec(s)) + F.lit(float(q))
        own = F.col(cluster) == F.lit(cid)
        a_expr = F.when(F.lit(n) > 1, total / F.lit(float(max(n - 1, 1))))
        own_a = F.when(own, a_expr) if own_a is None else own_a.when(own, a_expr)
        others.append(F.when(~own, total / F.lit(float(n))))
    if len(stats) < 2:
        return df.select(*names, F.lit(None).cast("double").alias("silhouette"))
    b = F.least(*others)
    a = own_a
    s = F.when(a.isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return df.select(*names, s.alias("silhouette"))


def silhouette_by_cluster(df: DataFrame, vec: str, cluster: str, noise: int | None = None) -> DataFrame:
    """Mean silhouette per cluster plus an overall row (cluster NULL)."""
    pts = silhouette_points(df, vec, cluster, noise)
    return pts.groupBy(cluster).agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("n")) \
        .unionByName(pts.agg(F.lit(None).cast(pts.schema[cluster].dataType).alias(cluster),
                             F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("n")))


def silhouette_score(df: DataFrame, vec: str, cluster: str, noise: int | None = None) -> float | None:
    """Overall mean silhouette; None with fewer than 2 clusters or <= 1 row."""
    d = df.where(F.col(cluster) != noise) if noise is not None else df
    k = d.select(cluster).distinct().count()
    if k < 2:
        return None
    return silhouette_points(d, vec, cluster).agg(F.avg("silhouette")).first()[0]


# ------------------------------------------------------------------ profiles

def cluster_profile(df: DataFrame, cluster: str, means: Sequence[str], label: str | None = None,
                    noise: int | None = None) -> DataFrame:
    """Size and mean of each column per cluster (label mean = churn rate)."""
    d = df.where(F.col(cluster) != noise) if noise is not None else df
    aggs = [F.count(F.lit(1)).alias("cluster_size")] + [F.avg(c).alias(c) for c in means]
    if label:
        aggs.append(F.avg(F.col(label).cast("double")).alias("churn_rate"))
    return d.groupBy(cluster).agg(*aggs)


def churn_variance(profile: DataFrame, rate: str = "churn_rate") -> DataFrame:
    """Population variance of the per-cluster rates (unweighted); 0 for <= 1 cluster."""
    return profile.agg(F.coalesce(F.when(F.count(rate) > 1, F.var_pop(rate)), F.lit(0.0)).alias("churn_variance"),
                       F.count(rate).alias("n_clusters"))


def cluster_kpis(profile: DataFrame, cluster: str, rate: str = "churn_rate") -> DataFrame:
    """Number of clusters, highest- and lowest-rate cluster (ties -> smaller id)."""
    return profile.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.max_by(F.col(cluster), F.struct(F.col(rate), -F.col(cluster))).alias("highest_cluster"),
        F.max(rate).alias("highest_rate"),
        F.min_by(F.col(cluster), F.struct(F.col(rate), F.col(cluster))).alias("lowest_cluster"),
        F.min(rate).alias("lowest_rate"))


def radar(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Per-cluster and whole-table means of each feature, min-max normalised
    against the column's range (zero range -> 1e-9), long form."""
    rng = df.agg(*[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(features)],
                 *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(features)],
                 *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)]).first()
    per = df.groupBy(cluster).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)])
    structs = []
    for i, c in enumerate(features):
        lo, hi = F.lit(rng[f"lo{i}"]), F.lit(rng[f"hi{i}"])
        structs.append(F.struct(F.lit(c).alias("feature"), F.lit("cluster").alias("scope"),
                                F.col(f"m{i}").alias("mean"), minmax_normalise(F.col(f"m{i}"), lo, hi).alias("normalised")))
        structs.append(F.struct(F.lit(c).alias("feature"), F.lit("dataset").alias("scope"),
                                F.lit(rng[f"m{i}"]).alias("mean"),
                                minmax_normalise(F.lit(rng[f"m{i}"]), lo, hi).alias("normalised")))
    return per.select(cluster, F.inline(F.array(*structs)))


def share_mix(df: DataFrame, cluster: str, onehots: Sequence[str]) -> DataFrame:
    """Share of each one-hot level inside each cluster and in the whole table."""
    per = df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in onehots]).select(
        F.col(cluster).cast("string").alias("scope"), *onehots)
    whole = df.agg(*[F.avg(c).alias(c) for c in onehots]).select(F.lit("dataset").alias("scope"), *onehots)
    return per.unionByName(whole).unpivot(["scope"], list(onehots), "level", "share")


# ------------------------------------------------------------------ components and chosen clusterings

def to_vector(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def pca_fit(df: DataFrame, cols: Sequence[str], target: float = 0.90):
    """Centre (Spark's PCA does not), fit with k = d, keep the fewest
    components explaining >= target of the variance (W6 on <= d values).
    Returns (model, k, explained variances, means)."""
    from pyspark.ml.feature import PCA
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    centred = to_vector(df.select(*[(F.col(c) - F.lit(means[c])).alias(c) for c in cols]), cols)
    model = PCA(k=len(cols), inputCol="features", outputCol="pca").fit(centred)
    ev = list(model.explainedVariance.toArray())
    cum, k = 0.0, len(ev)
    for i, v in enumerate(ev):
        cum += v
        if cum >= target:
            k = i + 1
            break
    return model, k, ev, means


def pca_project(df: DataFrame, cols: Sequence[str], model, means: dict, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """Project centred rows; adds ``pca`` (array, first k) and PCA1/PCA2."""
    from pyspark.ml.functions import vector_to_array
    centred = df.select(*keep, *[(F.col(c) - F.lit(means[c])).alias(c) for c in cols])
    out = model.transform(to_vector(centred, cols)).withColumn("pca_all", vector_to_array("pca"))
    return out.select(*keep, F.slice("pca_all", 1, k).alias("pca"), F.col("pca_all")[0].alias("PCA1"),
                      F.col("pca_all")[1].alias("PCA2"))


def kmeans_chosen(runs):
    """Of ``lloyd.fit_many``'s runs, the best run of the k with the highest silhouette (first maximum; runs without one last)."""
    from churnkit.operators.lloyd import best_run
    best = [best_run(runs, k) for k in sorted({m.k for m in runs})]
    return max(best, key=lambda m: -2.0 if m.silhouette is None else m.silhouette)


def parallel_map(fn, items, workers: int = 4):
    """Run independent Spark jobs from a few driver threads (order preserved)."""
    from concurrent.futures import ThreadPoolExecutor
    if len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as ex:
        return list(ex.map(fn, items))
