"""Exact, table-level evaluation of scores.

Everything reduces the scored table to small aggregates first:

* distinct-score counts ``(by, score, pos, neg)`` for AUC and PR curves, with
  range-partitioned running sums (any number of distinct scores);
* 201 threshold buckets per group for the threshold sweep — each score is
  assigned to the last grid threshold <= score, so the sweep is one pass
  plus reverse running sums over 201 rows (never a 201 x n matrix).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.operators.ranking import join_null_safe, running_counts_desc, running_sums


def _t(t) -> Column:
    if isinstance(t, Column):
        return t
    if isinstance(t, str):
        return F.col(t)
    if isinstance(t, dict):
        from churnkit.functions.encode import map_values
        return map_values("model", {k: float(v) for k, v in t.items()})
    return F.lit(float(t))


def score_counts(df: DataFrame, score: str, label: str, by=None) -> DataFrame:
    by = list(by or [])
    return df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"))


def roc_auc(df: DataFrame, score: str, label: str, by=None) -> DataFrame:
    """Exact ROC-AUC with ties counted half: sum_s pos_s (neg_below_s + neg_s / 2) / (P N)."""
    by = list(by or [])
    c = running_sums(score_counts(df, score, label, by), score, ["neg"], by, descending=False, inclusive=False)
    c = c.withColumnRenamed("cum_neg", "neg_below")
    agg = c.groupBy(*by).agg(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)).alias("_u"),
                             F.sum("pos").alias("_tot_pos"), F.sum("neg").alias("_tot_neg"))
    return agg.select(*by, F.try_divide(F.col("_u"), F.col("_tot_pos") * F.col("_tot_neg")).alias("auc"),
                      F.col("_tot_pos").alias("n_pos"), F.col("_tot_neg").alias("n_neg"))


def threshold_bucket(score: str, steps: int = 200) -> Column:
    """Index of the last grid threshold i/steps that is <= score (0..steps)."""
    s = F.col(score)
    i = F.floor(s * steps).cast("int")
    i = F.when(i.cast("double") / steps > s, i - 1).when((i + 1).cast("double") / steps <= s, i + 1).otherwise(i)
    return F.greatest(F.least(i, F.lit(steps)), F.lit(-1))


def threshold_sweep(df: DataFrame, score: str, label: str, by=None, steps: int = 200, beta: float = 2.0) -> DataFrame:
    """Precision, recall, F-beta at every threshold i/steps, i = 0..steps.

    ``p >= t_i`` holds exactly when bucket(p) >= i, so TP(i) / FP(i) are reverse
    running sums of per-bucket counts.  Zero denominators give 0.
    """
    by = list(by or [])
    b = df.where(F.col(score).isNotNull()).select(*by, threshold_bucket(score, steps).alias("b"),
                                                  F.when(F.col(label) == 1, 1).otherwise(0).alias("y"))
    per = b.groupBy(*by, "b").agg(F.sum("y").cast("long").alias("pos"),
                                  F.sum(1 - F.col("y")).cast("long").alias("neg"))
    # complete the grid without a cross join: per group a map bucket -> counts, then explode 0..steps
    grid = per.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("b", F.struct("pos", "neg")))).alias("m"),
        F.sum("pos").alias("_tot_pos"), F.sum("neg").alias("_tot_neg"))
    cells = grid.select(*by, "_tot_pos", "_tot_neg", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("i"), "m").select(
        *by, "_tot_pos", "_tot_neg", "i", F.coalesce(F.col("m")[F.col("i")]["pos"], F.lit(0)).alias("pos"),
        F.coalesce(F.col("m")[F.col("i")]["neg"], F.lit(0)).alias("neg"))
    w = Window.partitionBy(*by).orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    s = cells.select(*by, "i", "_tot_pos", "_tot_neg", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"))
    b2 = beta * beta
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("_tot_pos") - tp
    fb_den = (1 + b2) * tp + b2 * fn + fp
    return s.select(
        *by, "i", (F.col("i") / F.lit(float(steps))).alias("threshold"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
        (F.col("_tot_neg") - fp).cast("long").alias("tn"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, F.col("_tot_pos")), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide((1 + b2) * tp, fb_den), F.lit(0.0)).alias("f_beta"),
    )


def best_threshold(sweep: DataFrame, by=None) -> DataFrame:
    """The threshold maximising F-beta; the lowest threshold wins ties."""
    from churnkit.operators.ranking import first_max
    return first_max(sweep, "f_beta", "i", list(by or []))


def confusion_counts(df: DataFrame, score: str, label: str, t, by=None) -> DataFrame:
    """One row per group with tp, fp, fn, tn at threshold ``t`` (``p >= t``)."""
    by = list(by or [])
    pred = F.col(score) >= _t(t)
    y = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count(F.when(pred & y, 1)).alias("tp"), F.count(F.when(pred & ~y, 1)).alias("fp"),
        F.count(F.when(~pred & y, 1)).alias("fn"), F.count(F.when(~pred & ~y, 1)).alias("tn"))


def confusion_matrix(df: DataFrame, score: str, label: str, t, by=None) -> DataFrame:
    """The four cells (actual, predicted, n), always complete."""
    by = list(by or [])
    c = confusion_counts(df, score, label, t, by)
    cells = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("n"))
             for a, p, n in ((1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn"))]
    return c.select(*by, F.inline(F.array(*cells)))


def _prf(tp, fp, fn):
    p = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    r = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    return p, r, f1


def classification_report(df: DataFrame, score: str, label: str, t, by=None) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages (zero division -> 0), long form."""
    by = list(by or [])
    c = confusion_counts(df, score, label, t, by)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = _prf(tp, fp, fn)
    p0, r0, f0 = _prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = [
        ("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"),
         F.coalesce(F.try_divide(tp + tn, n), F.lit(0.0)), n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", F.coalesce(F.try_divide(p0 * s0 + p1 * s1, n), F.lit(0.0)),
         F.coalesce(F.try_divide(r0 * s0 + r1 * s1, n), F.lit(0.0)),
         F.coalesce(F.try_divide(f0 * s0 + f1 * s1, n), F.lit(0.0)), n),
    ]
    structs = [F.struct(F.lit(k).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("long").alias("support")) for k, p, r, f, s in rows]
    return c.select(*by, F.inline(F.array(*structs)))


def pr_curve(df: DataFrame, score: str, label: str, t=None, by=None) -> DataFrame:
    """precision/recall at each distinct score (descending), stopping at the
    first score reaching full recall, plus the end point (recall 0, precision 1).
    ``is_operating`` marks the lowest distinct score >= t."""
    by = list(by or [])
    c = score_counts(df, score, label, by)
    c = running_counts_desc(c, score, ["pos", "neg"], by)
    above = F.when(F.col(score) >= _t(t), F.col(score)) if t is not None else F.lit(None).cast("double")
    tot = c.groupBy(*by).agg(F.sum("pos").alias("_total_pos"), F.min(above).alias("_op"))
    c = join_null_safe(c, tot, by)
    c = c.where((F.col("cum_pos") - F.col("pos")) < F.col("_total_pos"))
    pts = c.select(*by, "_op", F.col(score).alias("score"),
                   F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                   F.coalesce(F.try_divide(F.col("cum_pos"), F.col("_total_pos")), F.lit(0.0)).alias("recall"))
    if t is not None:
        pts = pts.withColumn("is_operating", F.coalesce(F.col("score") == F.col("_op"), F.lit(False)))
    pts = pts.drop("_op")
    end_cols = [F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")]
    if t is not None:
        end_cols.append(F.lit(False).alias("is_operating"))
    ends = df.select(*by).distinct().select(*by, *end_cols) if by else df.sparkSession.range(1).select(*end_cols)
    return pts.unionByName(ends)


def threshold_kpis(df: DataFrame, score: str, label: str, t, by=None) -> DataFrame:
    """Predicted-positive rate, precision, recall, F2 (denominators max(1, .))."""
    by = list(by or [])
    c = confusion_counts(df, score, label, t, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return c.select(
        *by, (F.try_divide(tp + fp, F.greatest(n, F.lit(1))) * 100.0).alias("predicted_rate"),
        (tp / F.greatest(tp + fp, F.lit(1))).alias("precision"),
        (tp / F.greatest(tp + fn, F.lit(1))).alias("recall"),
        F.coalesce(F.try_divide(5 * tp, 5 * tp + 4 * fn + fp), F.lit(0.0)).alias("f2"))


def scoring_kpis(df: DataFrame, score: str, label: str, t, by=None) -> DataFrame:
    """Actual rate, positive/negative counts, AUC and the threshold used."""
    by = list(by or [])
    keys = by or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(1))
    k = df.groupBy(*keys).agg((F.avg(F.col(label).cast("double")) * 100.0).alias("actual_rate"),
                              F.count(F.when(F.col(label) == 1, 1)).alias("n_churn"),
                              F.count(F.when(F.col(label) != 1, 1)).alias("n_stay"))
    a = roc_auc(df, score, label, keys).select(*keys, "auc")
    out = k.join(a, keys)  # both sides hold one row per group
    return out.withColumn("threshold", _t(t)).drop("_all")
