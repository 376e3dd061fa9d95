"""Catalogue part 5: fitted models, fitted clusterings and the isolation
forest.  Random draws and iterative solvers make these rows-only checks
(no oracle SQL); their invariants are covered by the tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from churnkit.operators import boosting, evaluate, lloyd, models, newton, outliers, segments
from churnkit.plans import segmentation, training
from churnkit.plans.catalog import query, r6
from churnkit.plans.catalog_eval import SPLIT_SQL
from churnkit.plans.catalog_profile import CURATED_FEATURES
from churnkit.plans.oracle_sql import CURATED_CTE, CUSTOMER_CTE

#: The layers after the customers, as further common table expressions.
CURATED_ON_CUSTOMERS = CURATED_CTE[len(CUSTOMER_CTE):]

LR_SPEC = models.DEFAULT_MODELS[0]


NEWTON_D = len(CURATED_FEATURES) + 1


def newton_sql(steps: int, sets: str) -> str:
    """Newton steps from zero for the training sets ``sets`` (set_name, fold_out: a fold, -1 train, -2 train + val): CTEs w0 .. w<steps>
    (set_name, w).  Every system is solved by Gauss-Jordan elimination of its rows (Hessian | gradient)."""
    d = NEWTON_D
    x = ", ".join(f"CASE WHEN isfinite({c}::DOUBLE) THEN {c}::DOUBLE ELSE 0 END" for c in CURATED_FEATURES)
    out = SPLIT_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + CURATED_ON_CUSTOMERS + f""",
cur AS MATERIALIZED (SELECT c.customer_id, c.churn AS y, s.split, s.fold, [1.0::DOUBLE, {x}] AS x FROM curated c JOIN split s USING (customer_id)),
sets AS (SELECT * FROM (VALUES {sets}) t(set_name, fold_out)),
chosen AS (SELECT set_name, c.* FROM cur c JOIN sets ON (fold_out = -2 AND split <> 'test' OR split = 'train' AND fold <> fold_out)),
member AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY set_name) / (2.0::DOUBLE * count(*) OVER (PARTITION BY set_name, y)) AS sw FROM chosen),
w0 AS (SELECT set_name, list_transform(range({d}), lambda i: 0.0::DOUBLE) AS w FROM sets)"""
    for k in range(1, steps + 1):
        out += f""",
p{k} AS MATERIALIZED (SELECT set_name, x, sw, y, 1 / (1 + exp(-list_dot_product(w, x))) AS p FROM member JOIN w{k - 1} USING (set_name)),
h{k} AS (SELECT set_name, i, j, sum(CASE WHEN j > {d} THEN sw * (p - y) * x[i] ELSE sw * p * (1 - p) * x[i] * x[j] END) AS v
         FROM p{k}, range(1, {d + 1}) a(i), range(1, {d + 2}) b(j) GROUP BY ALL),
m{k} AS (SELECT set_name, list(r ORDER BY i) AS m FROM (SELECT h.set_name, i, list(v + CASE WHEN i = j THEN 1 WHEN j > {d} THEN w[i] ELSE 0 END ORDER BY j) AS r
         FROM h{k} h JOIN w{k - 1} USING (set_name) GROUP BY ALL) GROUP BY set_name),
e{k} AS (SELECT set_name, 1 AS c, m FROM m{k} UNION ALL
         SELECT set_name, c + 1, list_transform(m, lambda r, i: CASE WHEN i = c THEN list_transform(r, lambda v: v / r[c])
                ELSE list_transform(r, lambda v, j: v - r[c] * m[c][j] / m[c][c]) END) FROM e{k} WHERE c <= {d}),
w{k} AS MATERIALIZED (SELECT set_name, list_transform(w, lambda v, i: v - m[i][{d + 1}]) AS w FROM e{k} JOIN w{k - 1} USING (set_name) WHERE c = {d + 1})"""
    return out


#: Newton steps of the SQL: more than the fits on these tables need to reach the last digit.
NEWTON_STEPS = 9
FOLD_SETS = ", ".join(f"('fold{i}', {i})" for i in range(5))
NAMES_SQL = "['(intercept)', " + ", ".join(f"'{c}'" for c in CURATED_FEATURES) + "]"


@query("lr_newton_steps", newton_sql(2, FOLD_SETS + ", ('tune', -1), ('final', -2)") + "".join(
    f" {'UNION ALL' if k > 1 else ''} SELECT set_name, {k} AS step, unnest({NAMES_SQL}) AS feature, unnest(list_transform(w, lambda v: round(v, 6))) AS coefficient FROM w{k}"
    for k in (1, 2)))
def q_newton_steps(spark, d):
    """M5/M9: coefficients after the first two Newton steps, for the five folds and both refits."""
    data, feats = training.model_table(spark, d)
    return r6(newton.step_table(spark, newton.fit_many(data, feats, "churn", models.training_sets(), max_steps=2), (1, 2)))


@query("lr_fit_quality", " UNION ALL ".join(f"SELECT '{s}' AS set_name, true AS gradient_below_1e6, true AS objective_falls"
                                            for s in [*[f"fold{i}" for i in range(5)], "tune", "final"]))
def q_newton_quality(spark, d):
    """M5/M9: per training set, whether every entry of the gradient at the reported coefficients is below 1e-6 and
    the objective rose in no step (beyond the rounding of its sum)."""
    data, feats = training.model_table(spark, d)
    fits = newton.fit_many(data, feats, "churn", models.training_sets())
    rows = [(name, m.gradient < 1e-6, all(b[2] <= a[2] * (1 + newton.ROUNDING) for a, b in zip(m.trace, m.trace[1:])))
            for name, m in fits.items()]
    return spark.createDataFrame(rows, "set_name string, gradient_below_1e6 boolean, objective_falls boolean")


@query("lr_coefficients", newton_sql(NEWTON_STEPS, "('final', -2)") + f"""
SELECT feature, round(c, 6) AS coefficient, round(exp(c), 6) AS odds_ratio
FROM (SELECT unnest({NAMES_SQL}) AS feature, unnest(w) AS c FROM w{NEWTON_STEPS}) WHERE feature <> '(intercept)'""")
def q_lr_coefficients(spark, d):
    """M5 + M24 + P20: weighted L2 logistic regression refit on train+val; coefficients and odds ratios."""
    loaded, _ = training.load_fitted(spark, d, (LR_SPEC,))
    return r6(models.lr_coefficients(loaded[LR_SPEC.name]))


LR_TEST_SQL = newton_sql(NEWTON_STEPS, "('final', -2)") + f""",
scored AS (SELECT y, 1 / (1 + exp(-list_dot_product(w, x))) >= 0.5 AS hit FROM cur, w{NEWTON_STEPS} WHERE split = 'test'),
k AS (SELECT count(*) FILTER (y = 1 AND hit) AS tp, count(*) FILTER (y = 0 AND hit) AS fp, count(*) FILTER (y = 1 AND NOT hit) AS fn,
             count(*) FILTER (y = 0 AND NOT hit) AS tn FROM scored),
c AS (SELECT '0' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS p, coalesce(tn / nullif(tn + fp, 0), 0) AS r, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f,
             tn + fp AS n FROM k
      UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0), tp + fn FROM k)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, n AS support FROM c
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + tn + fp + fn), 6), tp + tn + fp + fn FROM k
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(n)::BIGINT FROM c
UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 6), round(sum(r * n) / sum(n), 6), round(sum(f * n) / sum(n), 6), sum(n)::BIGINT FROM c"""


@query("baseline_lr_report", LR_TEST_SQL)
def q_baseline(spark, d):
    """M6: baseline LR at threshold 0.5, classification report on the test split."""
    data, feats = training.model_table(spark, d)
    return r6(training.baseline_report(data, feats))


@query("lr_cv_metrics", newton_sql(NEWTON_STEPS, FOLD_SETS) + f""",
oof AS MATERIALIZED (SELECT y, 1 / (1 + exp(-list_dot_product(w, x))) AS p FROM cur JOIN sets ON fold = fold_out JOIN w{NEWTON_STEPS} USING (set_name) WHERE split = 'train'),
n AS (SELECT count(*) FILTER (y = 1) AS n_pos, count(*) FILTER (y = 0) AS n_neg, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp FROM oof),
s AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM oof GROUP BY p),
u AS (SELECT sum(pos * (below + neg / 2)) AS u FROM (SELECT *, sum(neg) OVER (ORDER BY p) - neg AS below FROM s))
SELECT round(u / (n_pos * n_neg), 6) AS auc, n_pos, n_neg, round(5 * tp / (4 * n_pos + tp + fp), 6) AS f2, round(tp / n_pos, 6) AS recall,
       round(tp / (tp + fp), 6) AS precision FROM n, u""")
def q_lr_cv(spark, d):
    """M9: out-of-fold 5-fold CV for the LR: one AUC / F2 over all OOF rows."""
    data, feats = training.model_table(spark, d)
    oof = models.oof_predictions(data.where(F.col("split") == "train"), LR_SPEC, feats, "churn", "customer_id")
    auc = evaluate.roc_auc(oof, "p", "churn").select("auc", "n_pos", "n_neg")
    f2 = evaluate.threshold_kpis(oof, "p", "churn", 0.5).select("f2", "recall", "precision")
    return r6(auc.withColumn("_k", F.lit(1)).join(f2.withColumn("_k", F.lit(1)), "_k").drop("_k"))


@query("training_report_lr")
def q_training_lr(spark, d):
    """Weighted LR, cross-validated, threshold tuned on validation by F2, refit on train+val, test metrics."""
    return r6(training.manifest_table(spark, d, models.DEFAULT_MODELS[:1]))


@query("training_report_rf")
def q_training_rf(spark, d):
    """Balanced random forest (200 trees) with the same protocol."""
    return r6(training.manifest_table(spark, d, models.DEFAULT_MODELS[1:2]))


@query("training_report_gbt")
def q_training_gbt(spark, d):
    """Boosted trees (200 x depth 5, lr 0.1, row and column sampling 0.9, positive-class weight)."""
    return r6(training.manifest_table(spark, d, models.DEFAULT_MODELS[2:]))


FEATURES_SQL = ("cur AS (SELECT c.* EXCLUDE (churn), c.churn AS y, s.split, s.fold FROM curated c JOIN split s USING (customer_id)),"
                " long AS (UNPIVOT (SELECT * REPLACE (" + ", ".join(
                    f"CASE WHEN isfinite({c}::DOUBLE) THEN {c}::DOUBLE ELSE 0 END AS {c}" for c in CURATED_FEATURES) + ") FROM cur)"
                " ON " + ", ".join(CURATED_FEATURES) + " INTO NAME feature VALUE x)")


@query("boosted_first_cuts", SPLIT_SQL + CURATED_ON_CUSTOMERS + ", " + FEATURES_SQL + f"""
, edge AS (SELECT feature, list_filter(list_sort(list_distinct(quantile_disc(x, {[i / 64 for i in range(1, 64)]}))), lambda e: e < max(x)) AS edges
           FROM long WHERE split <> 'test' GROUP BY feature),
coded AS (SELECT l.*, len(list_filter(edges, lambda e: e < x)) AS cut, len(edges) AS last,
                 ((('0x' || substr(md5(customer_id::VARCHAR), 1, 15))::UBIGINT::HUGEINT * {boosting.round_factor(0)}) % 18446744073709551616) // 17592186044416
                     < {round(0.9 * 2 ** 20)} AS drawn
          FROM long l JOIN edge USING (feature) WHERE split <> 'test'),
sets AS (SELECT 'fold' || i AS set_name, i AS fold_out FROM range(5) t(i) UNION ALL VALUES ('tune', -1), ('final', -2)),
member AS (SELECT set_name, c.* FROM coded c JOIN sets ON (fold_out = -2 OR split = 'train' AND fold <> fold_out)),
weight AS (SELECT set_name, sum(1 - y)::DOUBLE / greatest(1, sum(y)) AS w FROM member WHERE feature = 'tenure' GROUP BY 1),
sums AS (SELECT set_name, feature, cut, last, sum(CASE WHEN y = 1 THEN -0.5 * w ELSE 0.5 END) AS g, sum(CASE WHEN y = 1 THEN 0.25 * w ELSE 0.25 END) AS h
         FROM member JOIN weight USING (set_name) WHERE drawn GROUP BY ALL),
bins AS (SELECT set_name, feature, last, edges, unnest(range(last + 1)) AS cut FROM (SELECT DISTINCT set_name, feature, last FROM sums) JOIN edge USING (feature)),
dense AS (SELECT b.set_name, b.feature, b.last, b.edges, b.cut, coalesce(g, 0) AS g, coalesce(h, 0) AS h FROM bins b
          LEFT JOIN sums s ON b.set_name = s.set_name AND b.feature = s.feature AND b.cut = s.cut),
along AS (SELECT *, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(g) OVER (PARTITION BY set_name, feature) AS gt,
                 sum(h) OVER (PARTITION BY set_name, feature) AS ht FROM dense WINDOW up AS (PARTITION BY set_name, feature ORDER BY cut)),
gains AS (SELECT *, gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1) AS gain FROM along
          WHERE cut < last AND hl >= 1 AND ht - hl >= 1),
best AS (SELECT *, row_number() OVER (PARTITION BY set_name, feature ORDER BY round(gain, 9) DESC, cut) AS rn FROM gains)
SELECT set_name, feature, cut::INT AS cut, round(edges[cut + 1], 6) AS threshold, round(gain, 6) AS gain, round(hl, 6) AS cover_left FROM best WHERE rn = 1""")
def q_boosted_first(spark, d):
    """M8: quantile bins and every feature's best cut at the root of round 1, for the five folds and both refits."""
    data, feats = training.model_table(spark, d)
    return r6(boosting.first_cuts(data, feats, "churn", "customer_id", models.training_sets()))


@query("boosted_loss_curve")
def q_boosted_losses(spark, d):
    """M8/M9: weighted log-loss of the boosted trees before every round and at the end, per training set."""
    rows = json.loads(training.load_fitted(spark, d, models.DEFAULT_MODELS[2:])[1][0]["metrics"])["losses"]
    return r6(spark.createDataFrame([(s, i, x) for s, xs in rows.items() for i, x in enumerate(xs)], "set_name string, round int, loss double"), 9)


@query("fitted_model_comparison")
def q_fitted_comparison(spark, d):
    """M21 + E7: the three saved models by cross-validated AUC, from their manifests."""
    return r6(training.manifest_table(spark, d)).orderBy(F.col("cv_auc").desc())


@query("fitted_votes")
def q_fitted_votes(spark, d):
    """E7 + M19 + M20: all customers scored by the loaded models: probabilities, decisions, votes, consensus."""
    return r6(training.fitted_scores(spark, d))


@query("fitted_risk_ranking")
def q_fitted_risk(spark, d):
    """M22 + W1 on fitted, unrounded probabilities of the boosted trees."""
    name = models.DEFAULT_MODELS[2].name
    scores = training.fitted_scores(spark, d)
    t = training.manifest_table(spark, d, models.DEFAULT_MODELS[2:]).first()["threshold"]
    from churnkit.operators import scoring
    return r6(scoring.risk_table(scores, f"p_{name}", t, carry=("churn_pred_count", "consensus_label")))


FITTED_CHECKS = ("a_vote_for_each_model", "decisions_follow_thresholds", "one_score_per_customer", "out_of_fold_once",
                 "ranks_count_higher_scores")


@query("fitted_checks", " UNION ALL ".join(
    f"SELECT '{c}' AS check_name, CAST((SELECT count(*) FROM customer) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS violations"
    for c in FITTED_CHECKS if c != "out_of_fold_once") + " UNION ALL " + SPLIT_SQL.replace("WITH ", "SELECT * FROM (WITH ", 1)
    + " SELECT 'out_of_fold_once', count(*), CAST(0 AS BIGINT) FROM split WHERE split = 'train') oof")
def q_fitted_checks(spark, d):
    """Invariants of the fitted models: rows checked and rows that break them."""
    scores = training.fitted_scores(spark, d)
    manifest = training.manifest_table(spark, d).collect()
    names, key = [r["model"] for r in manifest], "customer_id"
    wrong = F.lit(False)
    for r in manifest:
        wrong = wrong | ((F.col(f"p_{r['model']}") >= r["threshold"]).cast("int") != F.col(f"pred_{r['model']}"))
    votes = sum((F.col(f"pred_{n}") for n in names[1:]), F.col(f"pred_{names[0]}"))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    one = scores.agg(F.count(F.lit(1)).alias("n"), count(votes != F.col("churn_pred_count")).alias("votes"), count(wrong).alias("wrong"),
                     (F.count(F.lit(1)) - F.count_distinct(key)).alias("twice")).first()
    data, feats = training.model_table(spark, d)
    oof = models.oof_predictions(data.where(F.col("split") == "train"), LR_SPEC, feats, "churn", key)
    train = data.where(F.col("split") == "train").select(key)
    folds = oof.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k")).first()
    missing = train.join(oof, key, "left_anti").count() + folds["n"] - folds["k"]
    from churnkit.operators.ranking import min_rank_desc, rank_violations
    p = f"p_{names[0]}"
    ranks = rank_violations(min_rank_desc(scores.select(key, p), p), p).first()
    rows = [("a_vote_for_each_model", one["n"], one["votes"]), ("decisions_follow_thresholds", one["n"], one["wrong"]),
            ("one_score_per_customer", one["n"], one["twice"]), ("out_of_fold_once", folds["n"], missing),
            ("ranks_count_higher_scores", ranks["n_rows"], ranks["violations"])]
    return spark.createDataFrame(rows, "check_name string, n_rows long, violations long")


@query("pca_variance")
def q_pca_variance(spark, d):
    """Explained variance per component, cumulative share, components kept (>= 90 %)."""
    _, k, ev = segmentation.pca_frame(spark, d)
    rows, cum = [], 0.0
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, float(v), float(cum), i + 1 <= k))
    return r6(spark.createDataFrame(rows, "component int, explained double, cumulative double, kept boolean"))


@query("pca_projection")
def q_pca_projection(spark, d):
    """PCA1/PCA2 coordinates per customer (centred before projection)."""
    proj, _, _ = segmentation.pca_frame(spark, d)
    return r6(proj.select("customer_id", "PCA1", "PCA2"))


@query("kmeans_k_sweep")
def q_kmeans_sweep(spark, d):
    """Silhouette (squared-Euclidean) of the best-of-10 k-means for k = 2..10."""
    return r6(segmentation.k_sweep(spark, d, "kmeans"))


LLOYD_KS, LLOYD_STARTS, LLOYD_ROUNDS = (2, 3, 4), (42, 43), 5


def lloyd_sql() -> str:
    """Assignments after LLOYD_ROUNDS rounds of every k and start on the curated features: one pair of CTEs a round."""
    x = ", ".join(f"CASE WHEN isfinite({c}::DOUBLE) THEN {c}::DOUBLE ELSE 0 END" for c in CURATED_FEATURES)
    starts = ", ".join(f"({k}, {s})" for k in LLOYD_KS for s in LLOYD_STARTS)
    out = f"""WITH {CURATED_CTE},
pts AS MATERIALIZED (SELECT customer_id, [{x}] AS x FROM curated),
runs AS (SELECT * FROM (VALUES {starts}) t(k, start)),
c0 AS (SELECT k, start, c, x AS m FROM (SELECT k, start, x, row_number() OVER (PARTITION BY k, start ORDER BY md5(concat_ws('|', customer_id, start)), customer_id) - 1 AS c
       FROM pts, runs) WHERE c < k)"""
    for r in range(LLOYD_ROUNDS + 1):
        out += f""",
a{r} AS MATERIALIZED (SELECT k, start, c, customer_id, x FROM pts, c{r}
  QUALIFY row_number() OVER (PARTITION BY k, start, customer_id ORDER BY list_distance(x, m), c) = 1)"""
        if r < LLOYD_ROUNDS:
            out += f""",
c{r + 1} AS MATERIALIZED (SELECT k, start, c, coalesce(new.m, old.m) AS m FROM c{r} old LEFT JOIN (SELECT k, start, c, list(v ORDER BY i) AS m
  FROM (SELECT k, start, c, i, avg(x[i]) AS v FROM a{r}, range(1, {len(CURATED_FEATURES) + 1}) t(i) GROUP BY ALL) GROUP BY ALL) new USING (k, start, c))"""
    return out + f" SELECT customer_id, k, start, c::INT AS cluster FROM a{LLOYD_ROUNDS}"


@query("kmeans_five_rounds", lloyd_sql())
def q_five_rounds(spark, d):
    """Cluster of every customer after five rounds of k-means on the curated features, for three k and two starts."""
    data, feats = training.model_table(spark, d)
    df = data.select("customer_id", segments.as_array(feats).alias("vec"))
    for m in lloyd.fit_many(df, "vec", "customer_id", LLOYD_KS, LLOYD_STARTS, LLOYD_ROUNDS, tol=0.0):
        df = segments.assign_nearest(df, "vec", m.table(), f"c_{m.k}_{m.start}", None)
    return df.select("customer_id", F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("start"), F.col(f"c_{k}_{s}").alias("cluster"))
                                                       for k in LLOYD_KS for s in LLOYD_STARTS])))


@query("fitted_clusters")
def q_fitted_clusters(spark, d):
    """K-means (best of 10 inits) and Gaussian-mixture labels per customer, k by silhouette."""
    return segmentation.fitted_clusters(spark, d).select("customer_id", "Cluster_KMeans", "Cluster_GMM")


METHODS = ("Cluster_KMeans", "Cluster_GMM", "Cluster_Density")


@query("clustered_layer")
def q_clustered_layer(spark, d):
    """E3 + D7: curated features with PCA1/PCA2 and the labels of all clusterings."""
    return r6(segmentation.clustered_layer(spark, d).drop("pca"))


@query("segmentation_comparison")
def q_segmentation_comparison(spark, d):
    """C10 + A21/A22 + C4/C9: per method the clusters (noise left out), the churn-rate variance and the
    squared-Euclidean silhouette in all kept components."""
    cl = segmentation.clustered_layer(spark, d)
    parts = []
    for m in METHODS:
        prof = segments.cluster_profile(cl, m, ["PCA1"], "churn", noise=-1)
        parts.append(segments.churn_variance(prof).withColumns({
            "method": F.lit(m), "silhouette_sq_euclidean": F.lit(segments.silhouette_score(cl, "pca", m, noise=-1)).cast("double")}))
    return r6(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("fitted_cluster_profile")
def q_fitted_profile(spark, d):
    """A21 on the fitted clusterings: size, mean of every feature and churn rate per method and cluster."""
    from churnkit.plans.catalog_profile import CURATED_FEATURES
    cl = segmentation.clustered_layer(spark, d)
    parts = [segments.cluster_profile(cl, m, CURATED_FEATURES, "churn", noise=-1).withColumnRenamed(m, "cluster").withColumn(
        "method", F.lit(m)) for m in METHODS]
    return r6(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("isolation_forest_scores")
def q_iso(spark, d):
    """O1 + O3: isolation-forest scores (100 trees x 256 samples) with the 3 % contamination cut."""
    return r6(segmentation.isolation_scores(spark, d))


def _isolation_top(spark, d, k=100):
    """(all customers with features, labels and anomaly score, the k most anomalous)."""
    s = segmentation.isolation_scores(spark, d).select("customer_id", F.col("IsoForest_Anomaly_Score").alias("anomaly_score"), "outlier")
    every = segmentation.clustered_layer(spark, d).join(s, "customer_id")
    return every, outliers.top_anomalies(every, "anomaly_score", "customer_id", k)


@query("isolation_top_anomalies")
def q_iso_top(spark, d):
    """O5 on the isolation forest: the 100 most anomalous customers with label and clusters."""
    return r6(_isolation_top(spark, d)[1].select("customer_id", "anomaly_score", "churn", *METHODS))


@query("isolation_feature_profile")
def q_iso_profile(spark, d):
    """A26 on the isolation forest: global vs top-100 mean of every feature."""
    from churnkit.plans.catalog_profile import CURATED_FEATURES
    every, top = _isolation_top(spark, d)
    return r6(outliers.anomaly_feature_profile(every, top, CURATED_FEATURES))


@query("isolation_per_cluster")
def q_iso_clusters(spark, d):
    """A27 on the isolation forest: top anomalies per cluster of each fitted clustering."""
    return outliers.anomalies_per_cluster(_isolation_top(spark, d)[1], list(METHODS))


@query("isolation_point_biserial")
def q_iso_pb(spark, d):
    """Point-biserial correlation of churn vs isolation score with its two-sided p-value."""
    s = segmentation.isolation_scores(spark, d)
    return r6(outliers.point_biserial_p(s, "churn", "iso_score"))


def _tree_attribution(spark, d, spec):
    from churnkit.operators import attribution
    loaded, rows = training.load_fitted(spark, d, (spec,))
    data, _ = training.model_table(spark, d)
    feats = list(rows[0]["feature_order"])
    model = loaded[spec.name]
    return attribution.path_attribution(data, getattr(model, "stages", [model])[-1], feats, "customer_id"), feats


def _rf_attribution(spark, d):
    return _tree_attribution(spark, d, models.DEFAULT_MODELS[1])


@query("boosted_global_impact")
def q_boosted_impact(spark, d):
    """Mean |contribution| per feature of the boosted trees (margin), over every customer."""
    from churnkit.operators import attribution
    attr, feats = _tree_attribution(spark, d, models.DEFAULT_MODELS[2])
    return r6(attribution.global_impact(attr, feats))


@query("boosted_attribution_sums", "SELECT CAST((SELECT count(*) FROM customer) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS violations")
def q_boosted_sums(spark, d):
    """Contributions of the boosted trees add up to prediction - base for every customer."""
    attr, _ = _tree_attribution(spark, d, models.DEFAULT_MODELS[2])
    off = F.abs(F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x) - (F.col("prediction") - F.col("base_value"))) > 1e-6
    return attr.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(off.cast("long")), F.lit(0)).alias("violations"))


@query("tree_attribution")
def q_tree_attribution(spark, d):
    """M26 (re-aimed): path attribution of the balanced random forest for every customer, top 15 by |value|."""
    from churnkit.operators import attribution
    attr, feats = _rf_attribution(spark, d)
    return r6(attribution.top_contributions(attr, feats, "customer_id", 15))


@query("tree_global_impact")
def q_tree_global_impact(spark, d):
    """Mean |path attribution| per feature over the whole table (no 500-row sample)."""
    from churnkit.operators import attribution
    attr, feats = _rf_attribution(spark, d)
    return r6(attribution.global_impact(attr, feats))


@query("density_clusters")
def q_density_clusters(spark, d):
    """C6 (re-aimed): grid density clusters with noise -1, minimum cluster size 50, in PCA space."""
    return r6(segmentation.density_clusters(spark, d).select("customer_id", "PCA1", "PCA2", "Cluster_Density"))


@query("density_cluster_summary")
def q_density_summary(spark, d):
    """C6 + F6 + A21/A22 + D1: clusters counted without noise, churn-rate variance across them."""
    cl = segmentation.density_clusters(spark, d)
    prof = segments.cluster_profile(cl, "Cluster_Density", ["PCA1", "PCA2"], "churn", noise=-1)
    noise = cl.agg(F.count(F.when(F.col("Cluster_Density") == -1, 1)).alias("n_noise"))
    vec = cl.withColumn("vec", F.array("PCA1", "PCA2"))
    sil = segments.silhouette_score(vec, "vec", "Cluster_Density", noise=-1)  # C9: NULL when < 2 clusters
    return r6(segments.churn_variance(prof).withColumn("_k", F.lit(1))
              .join(noise.withColumn("_k", F.lit(1)), "_k").drop("_k")
              .withColumn("silhouette_without_noise", F.lit(sil).cast("double")))
