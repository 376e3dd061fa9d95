"""Catalogue part 4: segmentation and outlier queries (C2/C4/C9 assignment
and silhouette, A21-A27, A28, A29, A31, O3-O7, J1, J2).

The SQL-checkable forms use deterministic centres (group means) and a
deterministic outlier score (distance from the mean in standardised space);
the fitted Spark ML clusterings and the isolation forest feed the same
operators in ``churnkit.plans.segmentation``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import outliers, profile, segments
from churnkit.plans.catalog import query, r6
from churnkit.plans.catalog_eval import LR, SCORED_CTE, curated, sql_prob
from churnkit.plans.catalog_profile import CURATED_FEATURES
from churnkit.plans.oracle_sql import with_curated
from churnkit.sources import adapters

NUM = ("tenure", "monthly", "total")
PROFILE_FEATURES = CURATED_FEATURES
SEGMENT_LEVELS = ("segment_AUTOMOBILE", "segment_BUILDING", "segment_FURNITURE", "segment_HOUSEHOLD",
                  "segment_MACHINERY")


# ------------------------------------------------------------------ embeddings: assignment + silhouette

EMB_CTE = ("WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),"
           " ex AS (SELECT vec_id, label, i, v[i] AS x FROM (SELECT vec_id, label, v,"
           " unnest(range(1, len(v) + 1)) AS i FROM e))")


@query("embedding_assign", EMB_CTE +
       ", cen AS (SELECT cid, list(m ORDER BY i) AS c FROM (SELECT label AS cid, i, avg(x) AS m FROM ex"
       " GROUP BY label, i) GROUP BY cid),"
       " d AS (SELECT e.vec_id, e.label, cen.cid, list_sum(list_transform(range(1, len(e.v) + 1),"
       " lambda i: (e.v[i] - cen.c[i]) * (e.v[i] - cen.c[i]))) AS d2 FROM e, cen),"
       " best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cid) AS rn FROM d)"
       " SELECT vec_id, label, cid AS cluster, round(sqrt(d2), 6) AS distance FROM best WHERE rn = 1")
def q_embedding_assign(spark, d):
    """C2 assignment step: each vector to the nearest label-mean centre (k x d literals, no join)."""
    emb = adapters.embedding_frame(spark, d)
    centres = segments.group_centroids(emb, "embedding", "label")
    return r6(segments.assign_nearest(emb, "embedding", centres).drop("embedding"))


@query("embedding_silhouette", EMB_CTE +
       ", cs AS (SELECT label AS cid, i, sum(x) AS s FROM ex GROUP BY label, i),"
       " px AS (SELECT vec_id, label, list_sum(list_transform(v, lambda a: a * a)) AS xx FROM e),"
       " cn AS (SELECT label AS cid, count(*) AS n, sum(xx) AS q FROM px GROUP BY label),"
       " dt AS (SELECT ex.vec_id, cs.cid, sum(ex.x * cs.s) AS dot FROM ex JOIN cs ON ex.i = cs.i"
       " GROUP BY ex.vec_id, cs.cid),"
       " tot AS (SELECT px.vec_id, px.label, dt.cid, cn.n, cn.n * px.xx - 2 * dt.dot + cn.q AS total FROM px"
       " JOIN dt ON px.vec_id = dt.vec_id JOIN cn ON dt.cid = cn.cid),"
       " ab AS (SELECT vec_id, label, max(CASE WHEN cid = label AND n > 1 THEN total / (n - 1) END) AS a,"
       " min(CASE WHEN cid <> label THEN total / n END) AS b FROM tot GROUP BY vec_id, label),"
       " s AS (SELECT label, CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0"
       " ELSE (b - a) / greatest(a, b) END AS sil FROM ab)"
       " SELECT label, round(avg(sil), 6) AS silhouette, count(*) AS n FROM s GROUP BY label"
       " UNION ALL SELECT NULL, round(avg(sil), 6), count(*) FROM s")
def q_embedding_silhouette(spark, d):
    """C4: squared-Euclidean silhouette per cluster and overall, linear in n (no pair join)."""
    emb = adapters.embedding_frame(spark, d)
    return r6(segments.silhouette_by_cluster(emb, "embedding", "label"))


# ------------------------------------------------------------------ customer clusters

def customer_clusters(spark, d):
    """Curated customers with two deterministic clusterings: centres = means
    per (churn, dependents) group (cluster) and per region (region_cluster)."""
    from churnkit.plans import etl
    r = adapters.raw_customers(spark, d)
    # the region label rides along from the raw row (no join back on the key)
    cur = etl.curated_from_raw(r, passthrough=("region",)).withColumnRenamed("raw_region", "region")
    vec = cur.withColumn("vec", segments.as_array(NUM))
    # both centre sets in one pass: GROUPING SETS ((churn, dependents), (region))
    g = vec.withColumn("_g", F.struct("churn", "dependents"))
    rows = (g.groupingSets([[F.col("_g")], [F.col("region")]], "_g", "region")
            .agg(*[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(len(NUM))], F.grouping_id().alias("_gid"))
            .collect())
    by_pair = sorted((r["_g"], [r[f"m{i}"] for i in range(len(NUM))]) for r in rows if r["_gid"] == 1)
    by_region = sorted((r["region"], [r[f"m{i}"] for i in range(len(NUM))])
                       for r in rows if r["_gid"] == 2 and r["region"] is not None)
    c1 = [(i, v) for i, (_, v) in enumerate(by_pair)]
    c2 = [(i, v) for i, (_, v) in enumerate(by_region)]
    out = segments.assign_nearest(vec, "vec", c1, "cluster", "distance")
    out = segments.assign_nearest(out, "vec", c2, "region_cluster", None)
    return out.drop("vec", "region")


CLUSTER_CTE = (
    ", grp AS (SELECT avg(tenure) AS ct, avg(monthly) AS cm, avg(total) AS cc,"
    " CAST(row_number() OVER (ORDER BY churn, dependents) - 1 AS INTEGER) AS cid FROM curated GROUP BY churn, dependents),"
    " grp2 AS (SELECT avg(c.tenure) AS ct, avg(c.monthly) AS cm, avg(c.total) AS cc,"
    " CAST(row_number() OVER (ORDER BY r.region) - 1 AS INTEGER) AS cid FROM curated c JOIN raw r"
    " ON c.customer_id = r.customer_id WHERE r.region IS NOT NULL GROUP BY r.region),"
    " d1 AS (SELECT c.customer_id, g.cid, (c.tenure - g.ct) * (c.tenure - g.ct) + (c.monthly - g.cm) * (c.monthly - g.cm)"
    " + (c.total - g.cc) * (c.total - g.cc) AS d2 FROM curated c, grp g),"
    " d2t AS (SELECT c.customer_id, g.cid, (c.tenure - g.ct) * (c.tenure - g.ct) + (c.monthly - g.cm) * (c.monthly - g.cm)"
    " + (c.total - g.cc) * (c.total - g.cc) AS d2 FROM curated c, grp2 g),"
    " a1 AS (SELECT customer_id, cid, d2 FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY d2, cid)"
    " AS rn FROM d1) WHERE rn = 1),"
    " a2 AS (SELECT customer_id, cid FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY d2, cid)"
    " AS rn FROM d2t) WHERE rn = 1),"
    " clustered AS (SELECT c.*, a1.cid AS cluster, sqrt(a1.d2) AS distance, a2.cid AS region_cluster FROM curated c"
    " JOIN a1 ON c.customer_id = a1.customer_id JOIN a2 ON c.customer_id = a2.customer_id)")


def with_clusters(body: str) -> str:
    return with_curated(CLUSTER_CTE + "\n" + body)


@query("customer_clusters", with_clusters(
    "SELECT customer_id, cluster, round(distance, 6) AS distance, region_cluster FROM clustered"))
def q_customer_clusters(spark, d):
    """C2 assignment on customers (two deterministic clusterings)."""
    return r6(customer_clusters(spark, d).select("customer_id", "cluster", "distance", "region_cluster"))


PROFILE_SQL = ("SELECT cluster, count(*) AS cluster_size, "
               + ", ".join(f"round(avg({c}), 6) AS {c}" for c in PROFILE_FEATURES)
               + ", round(avg(CAST(churn AS DOUBLE)), 6) AS churn_rate FROM clustered GROUP BY cluster")


@query("cluster_profile", with_clusters(PROFILE_SQL))
def q_cluster_profile(spark, d):
    """Size, feature means and churn rate per cluster."""
    return r6(segments.cluster_profile(customer_clusters(spark, d), "cluster", PROFILE_FEATURES, "churn"))


@query("cluster_churn_variance", with_clusters(
    f", prof AS ({PROFILE_SQL}) SELECT round(CASE WHEN count(churn_rate) > 1 THEN var_pop(churn_rate) ELSE 0.0 END, 6)"
    " AS churn_variance, count(churn_rate) AS n_clusters FROM prof"))
def q_cluster_variance(spark, d):
    """Population variance of churn rate across clusters."""
    prof = segments.cluster_profile(customer_clusters(spark, d), "cluster", PROFILE_FEATURES, "churn")
    return r6(segments.churn_variance(prof))


@query("cluster_kpis", with_clusters(
    f", prof AS ({PROFILE_SQL}) SELECT count(*) AS n_clusters,"
    " (SELECT cluster FROM prof ORDER BY churn_rate DESC, cluster LIMIT 1) AS highest_cluster,"
    " round(max(churn_rate), 6) AS highest_rate,"
    " (SELECT cluster FROM prof ORDER BY churn_rate, cluster LIMIT 1) AS lowest_cluster,"
    " round(min(churn_rate), 6) AS lowest_rate FROM prof"))
def q_cluster_kpis(spark, d):
    """Cluster count, highest- and lowest-churn cluster."""
    prof = segments.cluster_profile(customer_clusters(spark, d), "cluster", PROFILE_FEATURES, "churn")
    return r6(segments.cluster_kpis(prof, "cluster"))


def _radar_sql():
    parts = []
    for c in NUM:
        rng = f"(SELECT min({c}) AS lo, max({c}) AS hi, avg({c}) AS m FROM clustered)"
        parts.append(
            f"SELECT k.cluster, '{c}' AS feature, 'cluster' AS scope, round(avg(k.{c}), 6) AS mean,"
            f" round((avg(k.{c}) - r.lo) / greatest(r.hi - r.lo, 1e-9), 6) AS normalised FROM clustered k, {rng} r"
            " GROUP BY k.cluster, r.lo, r.hi")
        parts.append(
            f"SELECT k.cluster, '{c}', 'dataset', round(r.m, 6), round((r.m - r.lo) / greatest(r.hi - r.lo, 1e-9), 6)"
            f" FROM (SELECT DISTINCT cluster FROM clustered) k, {rng} r")
    return with_clusters(" UNION ALL ".join(parts))


@query("cluster_radar", _radar_sql())
def q_radar(spark, d):
    """A24 + P19: cluster vs dataset means, min-max normalised, long form."""
    return r6(segments.radar(customer_clusters(spark, d), "cluster", NUM))


@query("cluster_segment_mix", with_clusters(
    " UNION ALL ".join(
        [f"SELECT CAST(cluster AS VARCHAR) AS scope, '{c}' AS level, round(avg({c}), 6) AS share FROM clustered"
         " GROUP BY cluster" for c in SEGMENT_LEVELS]
        + [f"SELECT 'dataset', '{c}', round(avg({c}), 6) FROM clustered" for c in SEGMENT_LEVELS])))
def q_segment_mix(spark, d):
    """One-hot level shares per cluster and for the dataset, long form."""
    return r6(segments.share_mix(customer_clusters(spark, d), "cluster", SEGMENT_LEVELS))


@query("cluster_silhouette", with_clusters(
    ", cs AS (SELECT cluster AS cid, count(*) AS n, sum(tenure) AS s1, sum(monthly) AS s2, sum(total) AS s3,"
    " sum(tenure * tenure + monthly * monthly + total * total) AS q FROM clustered GROUP BY cluster),"
    " tot AS (SELECT k.customer_id, k.cluster, cs.cid, cs.n, cs.n * (k.tenure * k.tenure + k.monthly * k.monthly"
    " + k.total * k.total) - 2 * (k.tenure * cs.s1 + k.monthly * cs.s2 + k.total * cs.s3) + cs.q AS total"
    " FROM clustered k, cs),"
    " ab AS (SELECT customer_id, cluster, max(CASE WHEN cid = cluster AND n > 1 THEN total / (n - 1) END) AS a,"
    " min(CASE WHEN cid <> cluster THEN total / n END) AS b FROM tot GROUP BY customer_id, cluster),"
    " s AS (SELECT cluster, CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0"
    " ELSE (b - a) / greatest(a, b) END AS sil FROM ab)"
    " SELECT cluster, round(avg(sil), 6) AS silhouette, count(*) AS n FROM s GROUP BY cluster"
    " UNION ALL SELECT NULL, round(avg(sil), 6), count(*) FROM s"))
def q_cluster_silhouette(spark, d):
    """C4 on the customer clusters (three scaled numeric features)."""
    cl = customer_clusters(spark, d).withColumn("vec", segments.as_array(NUM))
    return r6(segments.silhouette_by_cluster(cl, "vec", "cluster"))


@query("feature_covariance", with_curated(
    "SELECT s.* FROM (SELECT unnest([" + ", ".join(
        f"{{'col_a': '{a}', 'col_b': '{b}', 'covariance': round(covar_pop({a}, {b}), 6)}}"
        for a in CURATED_FEATURES for b in CURATED_FEATURES) + "]) AS s FROM curated)"))
def q_covariance(spark, d):
    """C1 input: population covariance matrix of all model features (what PCA decomposes)."""
    return r6(profile.covariance_matrix(curated(spark, d), CURATED_FEATURES))


# ------------------------------------------------------------------ outliers on a deterministic score

def scored_outliers(spark, d):
    """Customers with clusters, the fixed LR probability and the distance score."""
    cl = customer_clusters(spark, d).withColumns({"score": outliers.centroid_distance(NUM), "p_lr": LR.prob()})
    cut = outliers.contamination_cut(cl, "score", 0.03)
    return outliers.flag_outliers(cl, "score", cut)


OUT_CTE = (
    ", sc0 AS (SELECT clustered.*, sqrt(tenure * tenure + monthly * monthly + total * total) AS score, "
    + sql_prob(LR) + " AS p_lr FROM clustered),"
    " cut AS (SELECT quantile_cont(score, 0.97) AS cut FROM sc0),"
    " osc AS (SELECT sc0.*, score - cut AS anomaly_score, CASE WHEN score - cut > 0 THEN -1 ELSE 1 END AS outlier"
    " FROM sc0, cut),"
    " top AS (SELECT * FROM osc ORDER BY anomaly_score DESC, customer_id LIMIT 100)")


def with_outliers(body: str) -> str:
    return with_clusters(OUT_CTE + "\n" + body)


@query("outlier_scores", with_outliers(
    "SELECT customer_id, round(score, 6) AS score, round(anomaly_score, 6) AS anomaly_score, outlier FROM osc"))
def q_outlier_scores(spark, d):
    """Score for all rows, contamination cut (3 %), label -1/1."""
    return r6(scored_outliers(spark, d).select("customer_id", "score", "anomaly_score", "outlier"))


@query("top_anomalies", with_outliers(
    "SELECT customer_id, round(anomaly_score, 6) AS anomaly_score, cluster, region_cluster, churn FROM top"))
def q_top_anomalies(spark, d):
    """The 100 most anomalous customers with their clusters and label."""
    top = outliers.top_anomalies(scored_outliers(spark, d), "anomaly_score", "customer_id", 100)
    return r6(top.select("customer_id", "anomaly_score", "cluster", "region_cluster", "churn"))


@query("anomaly_feature_profile", with_outliers(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(g.m, 6) AS global_mean, round(t.m, 6) AS anomaly_mean,"
    f" round(t.m - g.m, 6) AS difference,"
    f" round(CASE WHEN abs(g.m) < 1e-9 THEN NULL ELSE (t.m - g.m) / abs(g.m) * 100 END, 6) AS pct_difference"
    f" FROM (SELECT avg({c}) AS m FROM osc) g, (SELECT avg({c}) AS m FROM top) t" for c in PROFILE_FEATURES)))
def q_anomaly_profile(spark, d):
    """A26 + P18: global vs top-100 mean per feature, guarded % difference."""
    s = scored_outliers(spark, d)
    top = outliers.top_anomalies(s, "anomaly_score", "customer_id", 100)
    return r6(outliers.anomaly_feature_profile(s, top, PROFILE_FEATURES))


@query("anomalies_per_cluster", with_outliers(
    "SELECT 'cluster' AS method, cluster, count(*) AS n_anomalies FROM top GROUP BY cluster"
    " UNION ALL SELECT 'region_cluster', region_cluster, count(*) FROM top GROUP BY region_cluster"))
def q_anomalies_per_cluster(spark, d):
    """Top anomalies counted per cluster of each clustering."""
    top = outliers.top_anomalies(scored_outliers(spark, d), "anomaly_score", "customer_id", 100)
    return outliers.anomalies_per_cluster(top, ["cluster", "region_cluster"])


@query("point_biserial", with_outliers(
    "SELECT round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t FROM"
    " (SELECT corr(CAST(churn AS DOUBLE), score) AS r, count(*) AS n FROM osc)"))
def q_point_biserial(spark, d):
    """Point-biserial r between label and score, with its t statistic."""
    return r6(outliers.point_biserial(scored_outliers(spark, d), "churn", "score"))


@query("anomaly_kpis", with_outliers(
    ", scope AS (SELECT * FROM osc WHERE region_cluster IN (0, 1, 2))"
    " SELECT count(*) AS n_rows, count(CASE WHEN anomaly_score > 0 THEN 1 END) AS n_anomalies,"
    " round(avg(CASE WHEN anomaly_score > 0 THEN (CASE WHEN churn = 1 THEN 1.0 ELSE 0.0 END) END) * 100, 6)"
    " AS anomaly_churn_rate, round(avg(CASE WHEN churn = 1 THEN 1.0 ELSE 0.0 END) * 100, 6) AS churn_rate,"
    " round((avg(CASE WHEN anomaly_score > 0 THEN (CASE WHEN churn = 1 THEN 1.0 ELSE 0.0 END) END)"
    " - avg(CASE WHEN churn = 1 THEN 1.0 ELSE 0.0 END)) * 100, 6) AS delta_pp FROM scope"))
def q_anomaly_kpis(spark, d):
    """A29 (+ F2-style scope): rows in scope, visible anomalies, their churn rate and delta."""
    s = scored_outliers(spark, d).where(F.col("region_cluster").isin(0, 1, 2))
    return r6(outliers.anomaly_kpis(s, F.col("anomaly_score") > 0, "churn"))


@query("score_risk_quadrants", with_outliers(
    ", med AS (SELECT median(anomaly_score) AS mx, median(p_lr) AS my FROM osc)"
    " SELECT CASE WHEN anomaly_score >= mx THEN 'high' ELSE 'low' END AS anomaly_score_side,"
    " CASE WHEN p_lr >= my THEN 'high' ELSE 'low' END AS p_lr_side, count(*) AS n,"
    " round(mx, 7) AS anomaly_score_median, round(my, 7) AS p_lr_median FROM osc, med"
    " WHERE anomaly_score IS NOT NULL AND p_lr IS NOT NULL GROUP BY 1, 2, mx, my"))
def q_quadrants(spark, d):
    """A31 + O7: medians of anomaly score and churn probability, quadrant counts."""
    # seven places: the midpoint of two 6-place values would be a tie at six
    return r6(outliers.quadrants(scored_outliers(spark, d), "anomaly_score", "p_lr"), 7)


@query("anomaly_explanations", with_outliers(
    ", t10 AS (SELECT * FROM osc ORDER BY anomaly_score DESC, customer_id LIMIT 10),"
    " g AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in PROFILE_FEATURES) + " FROM osc),"
    " l AS (" + " UNION ALL ".join(
        f"SELECT t10.customer_id, '{c}' AS feature, CAST(t10.{c} AS DOUBLE) AS value, g.{c} AS global_mean"
        " FROM t10, g" for c in PROFILE_FEATURES) + "),"
    " p AS (SELECT *, CASE WHEN abs(global_mean) < 1e-9 THEN NULL ELSE (value - global_mean) / abs(global_mean) * 100"
    " END AS pct FROM l)"
    " SELECT customer_id, feature, round(value, 6) AS value, round(global_mean, 6) AS global_mean,"
    " round(pct, 6) AS pct_deviation, CASE WHEN abs(coalesce(pct, 0)) > 50 THEN 'red'"
    " WHEN abs(coalesce(pct, 0)) > 20 THEN 'orange' ELSE 'grey' END AS band FROM p"))
def q_explanations(spark, d):
    """O6 + P18: per-feature % deviation and band for the 10 top anomalies at once."""
    s = scored_outliers(spark, d)
    top = outliers.top_anomalies(s, "anomaly_score", "customer_id", 10)
    return r6(outliers.explain_rows(top, s, "customer_id", PROFILE_FEATURES))


@query("anomaly_prediction_join", with_outliers(
    SCORED_CTE.replace(", long AS", ", long_unused AS") +
    ", keys AS (SELECT customer_id FROM raw WHERE segment = 'BUILDING')"
    " SELECT k.customer_id, round(o.anomaly_score, 6) AS anomaly_score, o.outlier, s.p_rf, s.p_xgb"
    " FROM keys k LEFT JOIN osc o ON k.customer_id = o.customer_id LEFT JOIN scored s"
    " ON k.customer_id = s.customer_id"))
def q_anomaly_join(spark, d):
    """J1 + J2: filtered keys left-joined to all anomaly scores and to the predictions (natural key, D5/D6)."""
    from churnkit.operators.scoring import FIXED_SCORERS, score_table
    s = scored_outliers(spark, d).select("customer_id", "anomaly_score", "outlier")
    preds = score_table(curated(spark, d), FIXED_SCORERS, "customer_id", "churn").select("customer_id", "p_rf", "p_xgb")
    keys = adapters.raw_customers(spark, d).where(F.col("segment") == "BUILDING").select("customer_id")
    return r6(keys.join(s, "customer_id", "left").join(preds, "customer_id", "left"))

