"""Catalogue part 3: splits, weights, scoring and evaluation queries
(M1-M4, M10-M17, M19-M23, M25, M27, M28, M29, W1-W8, A30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnkit.operators import evaluate, profile, scoring, split
from churnkit.operators.scaling import fit_zscore
from churnkit.operators.scoring import FIXED_SCORERS, TEST_POLICIES, LinearScorer
from churnkit.plans import etl
from churnkit.plans.catalog import query, r6, raw
from churnkit.plans.oracle_sql import with_curated, with_customers

MODELS = tuple(s.name for s in FIXED_SCORERS)
THRESHOLDS = {s.name: s.threshold for s in FIXED_SCORERS}
LR = FIXED_SCORERS[0]


# ------------------------------------------------------------------ Spark side

def curated(spark, d):
    return etl.curated_from_raw(raw(spark, d))


def scored(spark, d):
    return scoring.score_table(curated(spark, d), FIXED_SCORERS, "customer_id", "churn")


def long_scored(spark, d):
    return scoring.long_scores(scored(spark, d), MODELS)


# ------------------------------------------------------------------ SQL side

def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_prob(s: LinearScorer, subs: dict | None = None) -> str:
    subs = subs or {}
    z = " + ".join([dbl(s.intercept)] + [f"{subs.get(f, f)} * {dbl(c)}" for f, c in s.coefs.items()])
    return f"round(1 / (1 + exp(-({z}))), {s.digits})"


SCORED_CTE = (", scored AS (SELECT customer_id, CAST(churn AS INTEGER) AS churn_actual, "
              + ", ".join(f"{sql_prob(s)} AS p_{s.name}" for s in FIXED_SCORERS) + " FROM curated)"
              + ", long AS (" + " UNION ALL ".join(
                  f"SELECT customer_id, churn_actual, '{m}' AS model, p_{m} AS p FROM scored" for m in MODELS) + ")"
              + ", thr AS (" + " UNION ALL ".join(
                  f"SELECT '{m}' AS model, {dbl(t)} AS t" for m, t in THRESHOLDS.items()) + ")")


def with_scored(body: str) -> str:
    return with_curated(SCORED_CTE + "\n" + body)


BUCKET = ("CASE WHEN CAST(i0 AS DOUBLE) / 200 > p THEN i0 - 1 WHEN CAST(i0 + 1 AS DOUBLE) / 200 <= p THEN i0 + 1 "
          "ELSE i0 END")

SWEEP_CTE = (
    ", b0 AS (SELECT model, p, CAST(floor(p * 200) AS INTEGER) AS i0,"
    " CASE WHEN churn_actual = 1 THEN 1 ELSE 0 END AS y FROM long WHERE p IS NOT NULL),"
    f" b AS (SELECT model, greatest(least({BUCKET}, 200), -1) AS b, y FROM b0),"
    " per AS (SELECT model, b, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY model, b),"
    " tot AS (SELECT model, CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM per GROUP BY model),"
    " cells AS (SELECT t.model, g.i, t.P, t.N, CAST(coalesce(per.pos, 0) AS DOUBLE) AS pos,"
    " CAST(coalesce(per.neg, 0) AS DOUBLE) AS neg FROM tot t CROSS JOIN range(0, 201) g(i)"
    " LEFT JOIN per ON per.model = t.model AND per.b = g.i),"
    " s AS (SELECT model, i, P, N,"
    " sum(pos) OVER (PARTITION BY model ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,"
    " sum(neg) OVER (PARTITION BY model ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp"
    " FROM cells),"
    " sweep AS (SELECT model, CAST(i AS INTEGER) AS i, CAST(i AS DOUBLE) / 200 AS threshold, CAST(tp AS BIGINT) AS tp,"
    " CAST(fp AS BIGINT) AS fp, CAST(P - tp AS BIGINT) AS fn, CAST(N - fp AS BIGINT) AS tn,"
    " CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,"
    " CASE WHEN P = 0 THEN 0.0 ELSE tp / P END AS recall,"
    " CASE WHEN 5 * tp + 4 * (P - tp) + fp = 0 THEN 0.0 ELSE 5 * tp / (5 * tp + 4 * (P - tp) + fp) END AS f_beta"
    " FROM s)")

CONF_CTE = (", conf AS (SELECT l.model, count(CASE WHEN p >= t AND churn_actual = 1 THEN 1 END) AS tp,"
            " count(CASE WHEN p >= t AND churn_actual <> 1 THEN 1 END) AS fp,"
            " count(CASE WHEN p < t AND churn_actual = 1 THEN 1 END) AS fn,"
            " count(CASE WHEN p < t AND churn_actual <> 1 THEN 1 END) AS tn"
            " FROM long l JOIN thr ON l.model = thr.model GROUP BY l.model)")

AUC_CTE = (", sc AS (SELECT model, p, CAST(sum(CASE WHEN churn_actual = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,"
           " CAST(sum(CASE WHEN churn_actual = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM long"
           " WHERE p IS NOT NULL GROUP BY model, p),"
           " sc2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING"
           " AND 1 PRECEDING), 0) AS neg_below FROM sc),"
           " auc AS (SELECT model, sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)) AS auc,"
           " CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM sc2 GROUP BY model)")


# ------------------------------------------------------------------ splits and weights (M1-M4)

SPLIT_SQL = with_customers(
    ", r AS (SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY"
    " md5(concat_ws('|', CAST(customer_id AS VARCHAR), '42')), customer_id) AS rk,"
    " count(*) OVER (PARTITION BY churn) AS cn FROM raw),"
    " r2 AS (SELECT *, CAST(floor(0.2::DOUBLE * cn + 0.5) AS BIGINT) AS nt, CAST(floor(0.2::DOUBLE * cn + 0.5) AS BIGINT)"
    " AS nv FROM r),"
    " split AS (SELECT customer_id, churn, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + nv THEN 'val' ELSE 'train'"
    " END AS split, CASE WHEN rk > nt + nv THEN CAST((rk - nt - nv - 1) % 5 AS INTEGER) END AS fold FROM r2)")


def split_frame(spark, d):
    return split.stratified_split(raw(spark, d).select("customer_id", "churn"), "churn", "customer_id")


@query("stratified_split", SPLIT_SQL + " SELECT * FROM split")
def q_split(spark, d):
    """M1 + M2: exact stratified 60/20/20 split by md5 order and round-robin CV folds."""
    return split_frame(spark, d)


@query("split_summary", SPLIT_SQL + " SELECT split, churn, fold, count(*) AS n FROM split GROUP BY split, churn, fold")
def q_split_summary(spark, d):
    """M1/M2 invariants: per split, label and fold counts."""
    return split_frame(spark, d).groupBy("split", "churn", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("class_weights", SPLIT_SQL +
       ", tr AS (SELECT * FROM split WHERE split = 'train'),"
       " cnt AS (SELECT churn, count(*) AS n FROM tr GROUP BY churn)"
       " SELECT churn, n, round(CAST((SELECT count(*) FROM tr) AS DOUBLE) / (2 * n), 6) AS weight,"
       " round(CAST((SELECT count(*) FROM tr WHERE churn = 'No') AS DOUBLE) /"
       " greatest(1, (SELECT count(*) FROM tr WHERE churn = 'Yes')), 6) AS pos_weight FROM cnt")
def q_class_weights(spark, d):
    """M3 balanced weights and M4 positive-class ratio, fitted on the train split."""
    train = split_frame(spark, d).where(F.col("split") == "train")
    w = split.balanced_weights(train, "churn")
    ratio = split.pos_weight_ratio(train, "churn", "Yes")
    return r6(w.groupBy("churn").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight"))
              .withColumn("pos_weight", F.lit(ratio)))


# ------------------------------------------------------------------ scoring

@query("fixed_scores", with_scored("SELECT customer_id, churn_actual, p_lr, p_rf, p_xgb FROM scored"))
def q_scores(spark, d):
    """Batch scoring of the curated table with three linear scorers."""
    return scored(spark, d)


VOTES_SQL = (", votes AS (SELECT *, CAST(pred_lr + pred_rf + pred_xgb AS INTEGER) AS churn_pred_count,"
             " CAST(3 - (pred_lr + pred_rf + pred_xgb) AS INTEGER) AS non_churn_pred_count FROM (SELECT scored.*, "
             + ", ".join(f"CAST(CASE WHEN p_{m} >= {dbl(t)} THEN 1 ELSE 0 END AS INTEGER) AS pred_{m}"
                         for m, t in THRESHOLDS.items()) + " FROM scored)),"
             " votes2 AS (SELECT *, CASE WHEN churn_pred_count > non_churn_pred_count THEN 'Churn'"
             " WHEN churn_pred_count < non_churn_pred_count THEN 'Stay' ELSE 'Tie' END AS consensus_label FROM votes)")


@query("model_votes", with_scored(VOTES_SQL + " SELECT * FROM votes2"))
def q_votes(spark, d):
    """Per-model decisions, votes, consensus."""
    return scoring.consensus(scored(spark, d), THRESHOLDS)


RISK_SELECT = (
    "SELECT s.customer_id, CAST(rank() OVER (ORDER BY s.p_lr DESC) AS BIGINT) AS risk_rank,"
    " round(s.p_lr * 100, 6) AS p_pct, round(abs(s.p_lr - 0.305::DOUBLE) * 100, 6) AS distance_pp,"
    " CASE WHEN s.p_lr >= 0.305::DOUBLE THEN 'Churn' ELSE 'Stay' END AS predicted,"
    " CASE WHEN s.churn_actual = 1 THEN 'Churn' WHEN s.churn_actual = 0 THEN 'Stay' END AS actual,"
    " CASE WHEN s.p_lr >= 0.305::DOUBLE AND s.churn_actual = 1 THEN 'TP' WHEN s.p_lr >= 0.305::DOUBLE AND"
    " s.churn_actual = 0 THEN 'FP' WHEN s.p_lr < 0.305::DOUBLE AND s.churn_actual = 1 THEN 'FN'"
    " WHEN s.p_lr < 0.305::DOUBLE AND s.churn_actual = 0 THEN 'TN' END AS outcome,"
    " v.churn_pred_count, v.consensus_label FROM scored s LEFT JOIN votes2 v ON s.customer_id = v.customer_id")


@query("risk_ranking", with_scored(VOTES_SQL + " " + RISK_SELECT))
def q_risk(spark, d):
    """Ranked prediction table with min-rank ties (W1), P15-P17 and consensus."""
    sc = scoring.consensus(scored(spark, d), THRESHOLDS)
    return r6(scoring.risk_table(sc, "p_lr", LR.threshold, carry=("churn_pred_count", "consensus_label")))


@query("risk_ranking_cohort", with_scored(
    VOTES_SQL + ", ranked AS (" + RISK_SELECT + ")"
    " SELECT * FROM ranked WHERE customer_id IN (SELECT customer_id FROM raw WHERE segment = 'AUTOMOBILE'"
    " AND region = 'ASIA')"))
def q_risk_cohort(spark, d):
    """M22 + F7/J4: ranks over everyone, shown for a drill-through cohort (semi-join)."""
    sc = scoring.consensus(scored(spark, d), THRESHOLDS)
    cohort = raw(spark, d).where((F.col("segment") == "AUTOMOBILE") & (F.col("region") == "ASIA"))
    return r6(scoring.risk_table(sc, "p_lr", LR.threshold, cohort=cohort,
                                 carry=("churn_pred_count", "consensus_label")))


@query("intervention_list", with_scored(
    "SELECT customer_id, churn_actual, p_lr, p_rf, p_xgb FROM scored ORDER BY p_lr DESC, customer_id LIMIT 50"))
def q_intervention(spark, d):
    """Top-50 customers by risk, ties by key."""
    return scoring.intervention_list(scored(spark, d), "p_lr", "customer_id", 50)


# ------------------------------------------------------------------ evaluation

@query("roc_auc", with_scored(AUC_CTE + " SELECT model, round(auc, 6) AS auc, n_pos, n_neg FROM auc"))
def q_auc(spark, d):
    """Exact ROC-AUC per model with half-credit ties."""
    return r6(evaluate.roc_auc(long_scored(spark, d), "p", "churn_actual", ["model"]))


@query("threshold_sweep", with_scored(
    SWEEP_CTE + " SELECT model, i, threshold, tp, fp, fn, tn, round(precision, 6) AS precision,"
    " round(recall, 6) AS recall, round(f_beta, 6) AS f_beta FROM sweep"))
def q_sweep(spark, d):
    """Precision / recall / F2 at 201 thresholds per model."""
    return r6(evaluate.threshold_sweep(long_scored(spark, d), "p", "churn_actual", ["model"]))


@query("best_threshold", with_scored(
    SWEEP_CTE + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f_beta DESC, i) AS rn"
    " FROM sweep) SELECT model, i, threshold, tp, fp, fn, tn, round(precision, 6) AS precision,"
    " round(recall, 6) AS recall, round(f_beta, 6) AS f_beta FROM ranked WHERE rn = 1"))
def q_best_threshold(spark, d):
    """M11 + W7: F2-maximising threshold per model, first maximum wins."""
    sweep = evaluate.threshold_sweep(long_scored(spark, d), "p", "churn_actual", ["model"])
    return r6(evaluate.best_threshold(sweep, ["model"]))


@query("confusion_matrix", with_scored(
    CONF_CTE + " SELECT model, 1 AS actual, 1 AS predicted, tp AS n FROM conf UNION ALL"
    " SELECT model, 0, 1, fp FROM conf UNION ALL SELECT model, 1, 0, fn FROM conf UNION ALL"
    " SELECT model, 0, 0, tn FROM conf"))
def q_confusion(spark, d):
    """Four complete cells per model at its default threshold."""
    return evaluate.confusion_matrix(long_scored(spark, d), "p", "churn_actual", THRESHOLDS, ["model"])


def _report_sql():
    c = ", c AS (SELECT model, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn," \
        " CAST(tn AS DOUBLE) AS tn FROM conf)"

    def prf(tp, fp, fn):
        return (f"CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE {tp} / ({tp} + {fp}) END",
                f"CASE WHEN {tp} + {fn} = 0 THEN 0.0 ELSE {tp} / ({tp} + {fn}) END",
                f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE 2 * {tp} / (2 * {tp} + {fp} + {fn}) END")
    p1, r1, f1 = prf("tp", "fp", "fn")
    p0, r0, f0 = prf("tn", "fn", "fp")
    m = (f", m AS (SELECT model, {p0} AS p0, {r0} AS r0, {f0} AS f0, {p1} AS p1, {r1} AS r1, {f1} AS f1,"
         " tn + fp AS s0, tp + fn AS s1, tp, tn FROM c)")

    def row(k, p, r, f, s):
        return (f"SELECT model, '{k}' AS class, round({p}, 6) AS precision, round({r}, 6) AS recall,"
                f" round({f}, 6) AS f1, CAST({s} AS BIGINT) AS support FROM m")
    n = "(s0 + s1)"
    rows = [row("0", "p0", "r0", "f0", "s0"), row("1", "p1", "r1", "f1", "s1"),
            row("accuracy", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)",
                f"CASE WHEN {n} = 0 THEN 0.0 ELSE (tp + tn) / {n} END", n),
            row("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", n),
            row("weighted avg", f"CASE WHEN {n} = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / {n} END",
                f"CASE WHEN {n} = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / {n} END",
                f"CASE WHEN {n} = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / {n} END", n)]
    return with_scored(CONF_CTE + c + m + " " + " UNION ALL ".join(rows))


@query("classification_report", _report_sql())
def q_report(spark, d):
    """M12 (and M6/M18 report shape): per-class and averaged metrics at default thresholds."""
    return r6(evaluate.classification_report(long_scored(spark, d), "p", "churn_actual", THRESHOLDS, ["model"]))


@query("pr_curve", with_scored(
    ", sc AS (SELECT model, p, CAST(sum(CASE WHEN churn_actual = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,"
    " CAST(sum(CASE WHEN churn_actual = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM long WHERE p IS NOT NULL"
    " GROUP BY model, p),"
    " cum AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND"
    " CURRENT ROW) AS cp, sum(neg) OVER (PARTITION BY model ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND"
    " CURRENT ROW) AS cn, sum(pos) OVER (PARTITION BY model) AS total_pos FROM sc),"
    " pts AS (SELECT c.model, p AS score, CASE WHEN cp + cn = 0 THEN NULL ELSE CAST(cp AS DOUBLE) / (cp + cn) END"
    " AS precision, CASE WHEN total_pos = 0 THEN 0.0 ELSE CAST(cp AS DOUBLE) / total_pos END AS recall, t FROM cum c"
    " JOIN thr ON c.model = thr.model WHERE cp - pos < total_pos),"
    " op AS (SELECT model, min(score) AS op FROM pts WHERE score >= t GROUP BY model)"
    " SELECT pts.model, round(score, 6) AS score, round(precision, 6) AS precision, round(recall, 6) AS recall,"
    " coalesce(score = op.op, false) AS is_operating FROM pts LEFT JOIN op ON pts.model = op.model"
    " UNION ALL SELECT model, NULL, 1.0, 0.0, false FROM thr"))
def q_pr(spark, d):
    """Precision-recall curve with operating point and end point."""
    return r6(evaluate.pr_curve(long_scored(spark, d), "p", "churn_actual", THRESHOLDS, ["model"]))


@query("threshold_kpis", with_scored(
    CONF_CTE + " SELECT model, round((tp + fp) * 100.0 / greatest(tp + fp + fn + tn, 1), 6) AS predicted_rate,"
    " round(CAST(tp AS DOUBLE) / greatest(tp + fp, 1), 6) AS precision,"
    " round(CAST(tp AS DOUBLE) / greatest(tp + fn, 1), 6) AS recall,"
    " round(CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0.0 ELSE 5.0 * tp / (5 * tp + 4 * fn + fp) END, 6) AS f2"
    " FROM conf"))
def q_threshold_kpis(spark, d):
    """Predicted rate, precision, recall, F2 at each model's threshold."""
    return r6(evaluate.threshold_kpis(long_scored(spark, d), "p", "churn_actual", THRESHOLDS, ["model"]))


@query("scoring_kpis", with_scored(
    AUC_CTE + ", k AS (SELECT model, avg(CAST(churn_actual AS DOUBLE)) * 100 AS actual_rate,"
    " count(CASE WHEN churn_actual = 1 THEN 1 END) AS n_churn, count(CASE WHEN churn_actual <> 1 THEN 1 END)"
    " AS n_stay FROM long GROUP BY model)"
    " SELECT k.model, round(actual_rate, 6) AS actual_rate, n_churn, n_stay, round(auc.auc, 6) AS auc,"
    " round(thr.t, 6) AS threshold FROM k JOIN auc ON k.model = auc.model JOIN thr ON k.model = thr.model"))
def q_scoring_kpis(spark, d):
    """Actual rate, class counts, AUC, threshold per model."""
    return r6(evaluate.scoring_kpis(long_scored(spark, d), "p", "churn_actual", THRESHOLDS, ["model"]))


@query("model_comparison", with_scored(
    AUC_CTE + CONF_CTE +
    " SELECT c.model, round(auc.auc, 6) AS auc, round(thr.t, 6) AS threshold,"
    " round(CAST(tp AS DOUBLE) / greatest(tp + fp, 1), 6) AS precision,"
    " round(CAST(tp AS DOUBLE) / greatest(tp + fn, 1), 6) AS recall,"
    " round(CASE WHEN 5 * tp + 4 * fn + fp = 0 THEN 0.0 ELSE 5.0 * tp / (5 * tp + 4 * fn + fp) END, 6) AS f2"
    " FROM conf c JOIN auc ON c.model = auc.model JOIN thr ON c.model = thr.model"))
def q_model_comparison(spark, d):
    """M21 (R1 unpivot): per-model AUC and metrics at default thresholds, sorted by AUC."""
    long = long_scored(spark, d)
    k = evaluate.threshold_kpis(long, "p", "churn_actual", THRESHOLDS, ["model"]).drop("predicted_rate")
    a = evaluate.roc_auc(long, "p", "churn_actual", ["model"]).select("model", "auc")
    from churnkit.functions.encode import map_values
    out = a.join(k, "model").withColumn("threshold", map_values("model", THRESHOLDS))
    return r6(out.orderBy(F.col("auc").desc()))


@query("score_quantiles_by_label", with_scored(" UNION ALL ".join(
    f"SELECT churn_actual, {dbl(round(0.05 * i, 2))} AS prob, round(quantile_disc(p_lr, {round(0.05 * i, 2)}), 6)"
    " AS quantile FROM scored WHERE p_lr IS NOT NULL AND churn_actual IS NOT NULL GROUP BY churn_actual"
    for i in range(1, 20))))
def q_quantiles(spark, d):
    """Quantile grid of the risk score per label (violin data)."""
    return r6(profile.quantile_grid(scored(spark, d), "p_lr", "churn_actual"))


# ------------------------------------------------------------------ attribution, scenarios

def _attr_sql():
    feats = list(LR.coefs)
    bg = ", bg AS (SELECT " + ", ".join(f"avg({f}) AS {f}" for f in feats) + " FROM curated)"
    base = " + ".join([dbl(LR.intercept)] + [f"bg.{f} * {dbl(c)}" for f, c in LR.coefs.items()])
    long = ", al AS (" + " UNION ALL ".join(
        f"SELECT c.customer_id, '{f}' AS feature, (c.{f} - bg.{f}) * {dbl(cf)} AS contribution FROM curated c, bg"
        for f, cf in LR.coefs.items()) + ")"
    return with_curated(
        bg + long + ", ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution)"
        " DESC, feature) AS INTEGER) AS position FROM al)"
        f" SELECT customer_id, feature, round(contribution, 6) AS contribution, position,"
        f" round((SELECT {base} FROM bg), 6) AS base_value FROM ranked WHERE position <= 15")


@query("linear_attribution", _attr_sql())
def q_attr(spark, d):
    """Per-customer linear attribution against the background mean, top 15 by |value|."""
    return r6(scoring.linear_attribution(curated(spark, d), LR, "customer_id"))


@query("linear_impact", with_curated(
    ", bg AS (SELECT " + ", ".join(f"avg({f}) AS {f}" for f in LR.coefs) + " FROM curated) " + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {dbl(c)} AS coefficient, round(avg(abs(c.{f} - bg.{f})) * {dbl(abs(c))}, 6)"
        " AS mean_abs_contribution FROM curated c, bg" for f, c in LR.coefs.items())))
def q_impact(spark, d):
    """M27 (linear): global mean |attribution| per feature over the whole table."""
    return r6(scoring.linear_impact(curated(spark, d), LR))


def _policy_sql(top_n: int | None = None, matching: bool = False) -> str:
    parts = []
    ctes = [", base AS (SELECT curated.*, " + sql_prob(LR) + " AS p_base FROM curated)"]
    for k, pol in enumerate(TEST_POLICIES):
        conds = [f"{c[:-len('_missing')]} = 0" if c.endswith("_missing") else f"{c} = 1" for c in pol.when_any]
        mask = "(" + " OR ".join(conds) + ")"
        if top_n:
            pool = f"FROM base WHERE {mask}" if matching else "FROM base"
            ctes.append(f", top{k} AS (SELECT customer_id {pool} ORDER BY p_base DESC, customer_id LIMIT {top_n})")
            mask = f"({mask} AND customer_id IN (SELECT customer_id FROM top{k}))"
        subs = {c: f"(CASE WHEN {mask} THEN 0 ELSE {c} END)" for c in pol.set_zero}
        subs.update({c: f"(CASE WHEN {mask} THEN 1 ELSE {c} END)" for c in pol.set_one})
        ctes.append(f", s{k} AS (SELECT p_base, {sql_prob(LR, subs)} AS p_new FROM base)")
        t = dbl(LR.threshold)
        parts.append(
            f"SELECT '{pol.name}' AS policy, round(avg(CASE WHEN p_base >= {t} THEN 1 ELSE 0 END), 6) AS base_rate,"
            f" round(avg(CASE WHEN p_new >= {t} THEN 1 ELSE 0 END), 6) AS scenario_rate,"
            f" count(CASE WHEN p_base <> p_new THEN 1 END) AS rows_affected,"
            f" round((avg(CASE WHEN p_new >= {t} THEN 1 ELSE 0 END) - avg(CASE WHEN p_base >= {t} THEN 1 ELSE 0 END))"
            f" * 100, 6) AS delta_pp FROM s{k}")
    return with_curated("".join(ctes) + " " + " UNION ALL ".join(parts))


@query("policy_impact", _policy_sql())
def q_policy(spark, d):
    """Three retention policies re-scored on all matching customers."""
    return r6(scoring.policy_impact(curated(spark, d), LR, TEST_POLICIES, "customer_id"))


@query("policy_impact_top100", _policy_sql(100))
def q_policy_top(spark, d):
    """Policies applied only inside the top-100 base-risk customers (reference meaning, D13)."""
    return r6(scoring.policy_impact(curated(spark, d), LR, TEST_POLICIES, "customer_id", top_n=100))


@query("policy_impact_top100_matching", _policy_sql(100, matching=True))
def q_policy_top_matching(spark, d):
    """M29 with scope='matching': top-100 among the customers the policy applies to."""
    return r6(scoring.policy_impact(curated(spark, d), LR, TEST_POLICIES, "customer_id", top_n=100,
                                    scope="matching"))


def _whatif_sql():
    subs = {"tenure": "((s.tenure + 12) - k.mt) / CASE WHEN k.st = 0 OR k.st IS NULL THEN 1 ELSE k.st END",
            "segment_AUTOMOBILE": "0", "segment_BUILDING": "1"}
    feats = {f: subs.get(f, f"c.{f}") for f in LR.coefs}
    prob = sql_prob(LR, feats)
    return with_curated(
        f" SELECT c.customer_id, {prob} AS p_churn, CASE WHEN {prob} >= {dbl(LR.threshold)} THEN 'Churn' ELSE 'Stay'"
        " END AS predicted FROM staging s JOIN curated c ON s.customer_id = c.customer_id CROSS JOIN scale k"
        " WHERE s.segment_AUTOMOBILE = 1")


@query("whatif_scenarios", _whatif_sql())
def q_whatif(spark, d):
    """Scenario rows (segment moved, tenure + 12) through the same fitted encoding and scaling."""
    r = raw(spark, d)
    levels = etl.discover_levels(r, ("segment", "region", "priority"))
    stats = fit_zscore(etl.staging_layer(r, levels=levels), ("tenure", "monthly", "total"))
    scen = r.where(F.col("segment") == "AUTOMOBILE").withColumns(
        {"segment": F.lit("BUILDING"), "tenure": F.col("tenure") + 12})
    return scoring.whatif(scen, lambda x: etl.staging_layer(x, levels=levels), stats, LR, "customer_id")


def _perm_sql():
    feats = list(LR.coefs)
    md5 = "md5(concat_ws('|', CAST(customer_id AS VARCHAR), '{}'))"
    ra = (", ra AS (SELECT customer_id, CAST(churn AS INTEGER) AS y, " + ", ".join(feats)
          + f", row_number() OVER (ORDER BY {md5.format(42)}, customer_id) AS r FROM curated)")
    rb = (f", rb AS (SELECT row_number() OVER (ORDER BY {md5.format(43)}, customer_id) AS r, "
          + ", ".join(f"{f} AS perm_{f}" for f in feats) + " FROM curated)")
    j = ", j AS (SELECT * FROM ra JOIN rb ON ra.r = rb.r)"
    long = ", long AS (SELECT '_base' AS feature, y, " + sql_prob(LR) + " AS p FROM j" + "".join(
        f" UNION ALL SELECT '{f}', y, {sql_prob(LR, {f: f'perm_{f}'})} FROM j" for f in feats) + ")"
    auc = (", sc AS (SELECT feature, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,"
           " sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg FROM long WHERE p IS NOT NULL GROUP BY feature, p),"
           " sc2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY p ROWS BETWEEN UNBOUNDED"
           " PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM sc),"
           " auc AS (SELECT feature, sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)) AS auc FROM sc2"
           " GROUP BY feature)")
    return with_curated(ra + rb + j + long + auc +
                        " SELECT feature, round(auc, 6) AS auc, round((SELECT auc FROM auc WHERE feature = '_base')"
                        " - auc, 6) AS importance FROM auc WHERE feature <> '_base'")


@query("permutation_importance", _perm_sql())
def q_permutation_importance(spark, d):
    """M27 (model-agnostic): AUC drop per permuted feature on the whole table, md5-defined permutation."""
    return r6(scoring.permutation_importance(curated(spark, d), LR, "customer_id", "churn"))


@query("onehot_filtered_rates", with_curated(
    " SELECT count(*) AS n, round(avg(CAST(churn AS DOUBLE)) * 100, 6) AS churn_rate,"
    " round(avg(tenure), 6) AS avg_tenure FROM curated"
    " WHERE (segment_AUTOMOBILE = 1 OR segment_MACHINERY = 1) AND (region_ASIA = 1 OR region_EUROPE = 1)"))
def q_onehot_filtered(spark, d):
    """filters on one-hot columns — OR inside a dimension, AND across; the unknown
    level and the absent dimension are skipped."""
    from churnkit.operators.filters import onehot_filter
    cur = onehot_filter(curated(spark, d), {"segment": ["AUTOMOBILE", "MACHINERY", "NO_SUCH_LEVEL"],
                                            "region": ["ASIA", "EUROPE"], "contract": ["Two year"]})
    return r6(cur.agg(F.count(F.lit(1)).alias("n"), (F.avg(F.col("churn").cast("double")) * 100.0).alias("churn_rate"),
                      F.avg("tenure").alias("avg_tenure")))
