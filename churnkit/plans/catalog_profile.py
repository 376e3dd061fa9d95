"""Catalogue part 2: profiling queries."""

from __future__ import annotations

from churnkit.operators import profile
from churnkit.plans import etl
from churnkit.plans.catalog import query, r6, raw
from churnkit.plans.oracle_sql import with_curated, with_customers
from churnkit.sources import adapters

TEXT_COLS = ("customer_id", "gender", "senior", "partner", "dependents", "paperless", "segment", "region", "priority",
             "tenure", "monthly", "total_text", "addon_click", "addon_error", "addon_purchase", "addon_signup",
             "addon_view", "churn")
STRING_TEXT_COLS = {"gender", "partner", "dependents", "paperless", "segment", "region", "priority", "total_text",
                    "addon_click", "addon_error", "addon_purchase", "addon_signup", "addon_view", "churn"}
NUMERIC = ("tenure", "monthly", "total")
CATEGORICAL = ("gender", "partner", "dependents", "paperless", "segment", "region", "priority", "addon_click",
               "addon_error", "addon_purchase", "addon_signup", "addon_view", "churn")
CURATED_FEATURES = (
    "gender", "partner", "dependents", "paperless", "senior", "tenure", "monthly", "total", "addon_click",
    "addon_error", "addon_purchase", "addon_signup", "addon_view", "segment_AUTOMOBILE", "segment_BUILDING",
    "segment_FURNITURE", "segment_HOUSEHOLD", "segment_MACHINERY", "region_AFRICA", "region_AMERICA", "region_ASIA",
    "region_EUROPE", "region_MIDDLE_EAST", "priority_1_URGENT", "priority_2_HIGH", "priority_3_MEDIUM",
    "priority_4_NOT_SPECIFIED", "priority_5_LOW")


def union_all(parts):
    return " UNION ALL ".join(parts)


@query("table_shape", with_customers(f"SELECT count(*) AS n_rows, {len(TEXT_COLS)} AS n_cols FROM raw"))
def q_table_shape(spark, d):
    """A1: rows and columns of the raw table."""
    return profile.table_shape(adapters.customer_frame(spark, d))


def _missing_sql():
    parts = []
    for c in TEXT_COLS:
        blank = f"CASE WHEN trim({c}) = '' THEN 1 ELSE 0 END" if c in STRING_TEXT_COLS else "0"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,"
            f" CAST(sum({blank}) AS BIGINT) AS n_blank,"
            f" round(round((sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) + sum({blank})) * 100.0 / greatest(count(*), 1),"
            f" 2), 6) AS pct_missing FROM cust_text")
    return with_customers(union_all(parts))


@query("missing_audit", _missing_sql())
def q_missing(spark, d):
    """A2: NULLs and blanks per column of the text-form table."""
    return r6(profile.missing_audit(adapters.customer_frame(spark, d)))


def _describe_sql():
    parts = [
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,"
        f" round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,"
        f" round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,"
        f" round(CAST(max({c}) AS DOUBLE), 6) AS max FROM raw" for c in NUMERIC]
    return with_customers(union_all(parts))


@query("describe_numeric", _describe_sql())
def q_describe(spark, d):
    """A3: count, mean, sample std, min, exact quartiles, max."""
    return r6(profile.describe(raw(spark, d), NUMERIC))


def _freq_sql():
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM raw" for c in CATEGORICAL]
    return with_customers(
        f", long AS ({union_all(parts)}), cnt AS (SELECT column_name, value, count(*) AS n FROM long"
        " WHERE value IS NOT NULL GROUP BY column_name, value)"
        " SELECT column_name, value, n, round(n * 100.0 / sum(n) OVER (PARTITION BY column_name), 6) AS pct FROM cnt")


@query("value_frequencies", _freq_sql())
def q_freq(spark, d):
    """A4 + A5: counts and relative frequencies per categorical column."""
    return r6(profile.value_frequencies(raw(spark, d), CATEGORICAL))


RAW_COLS = ("customer_id", "gender", "senior", "partner", "dependents", "paperless", "segment", "region", "priority",
            "tenure", "monthly", "total", "addon_click", "addon_error", "addon_purchase", "addon_signup",
            "addon_view", "churn")


@query("distinct_counts", with_customers(union_all(
    [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM raw" for c in RAW_COLS])))
def q_distinct(spark, d):
    """Distinct values per column."""
    return profile.distinct_counts(raw(spark, d), RAW_COLS)


@query("shape_moments", with_customers(union_all(
    [f"SELECT '{c}' AS column_name, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis FROM raw"
     for c in NUMERIC])))
def q_moments(spark, d):
    """Bias-corrected skewness and excess kurtosis."""
    return r6(profile.shape_moments(raw(spark, d), NUMERIC))


CORR_COLS = ("senior", "tenure", "monthly", "total")


def _corr_sql():
    parts = [f"SELECT '{c}' AS col_a, '{c}' AS col_b, 1.0::DOUBLE AS corr FROM raw LIMIT 1" for c in CORR_COLS]
    parts = [f"({p})" for p in parts]
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}', '{b}', round(corr({a}, {b}), 6) FROM raw")
            parts.append(f"SELECT '{b}', '{a}', round(corr({a}, {b}), 6) FROM raw")
    return with_customers(union_all(parts))


@query("correlation_matrix", _corr_sql())
def q_corr(spark, d):
    """Pearson correlation matrix, long form."""
    return r6(profile.correlation_matrix(raw(spark, d), CORR_COLS))


@query("stats_by_label", with_customers(union_all([
    f"SELECT '{c}' AS feature, churn, round(round(avg({c}), 2), 6) AS mean, round(round(median({c}), 2), 6) AS median,"
    f" round(round(stddev_samp({c}), 2), 6) AS std, round(round(CAST(min({c}) AS DOUBLE), 2), 6) AS min,"
    f" round(round(CAST(max({c}) AS DOUBLE), 2), 6) AS max FROM raw WHERE {c} IS NOT NULL AND churn IS NOT NULL"
    " GROUP BY churn" for c in NUMERIC])))
def q_stats_by_label(spark, d):
    """Distribution statistics by label and feature."""
    return r6(profile.stats_by_label(raw(spark, d), NUMERIC, "churn"))


HIST_COLS = ("tenure", "monthly")


def _hist_sql():
    parts = []
    for c in HIST_COLS:
        parts.append(
            f"SELECT '{c}' AS feature, g.churn, CAST(i AS INTEGER) AS bin, round(lo + i * w, 6) AS bin_start,"
            f" round(lo + (i + 1) * w, 6) AS bin_end, count(b.b) AS n FROM (SELECT DISTINCT churn FROM raw) g"
            f" CROSS JOIN e_{c} CROSS JOIN range(0, 30) r(i) LEFT JOIN b_{c} b ON b.churn = g.churn AND b.b = i"
            f" GROUP BY g.churn, i, lo, w")
    edges = "".join(
        f", e_{c} AS (SELECT CAST(min({c}) AS DOUBLE) AS lo, CASE WHEN max({c}) > min({c}) THEN"
        f" (CAST(max({c}) AS DOUBLE) - CAST(min({c}) AS DOUBLE)) / 30 ELSE 1.0 END AS w FROM raw)"
        f", b_{c} AS (SELECT churn, CAST(least(floor((CAST({c} AS DOUBLE) - lo) / w), 29) AS INTEGER) AS b FROM raw, e_{c}"
        f" WHERE {c} IS NOT NULL)" for c in HIST_COLS)
    return with_customers(f"{edges} {union_all(parts)}")


@query("histogram_by_label", _hist_sql())
def q_hist(spark, d):
    """30 equal-width bins per feature, split by label."""
    return r6(profile.histogram(raw(spark, d), HIST_COLS, "churn"))


@query("box_stats_by_label", with_customers(
    ", b AS (SELECT churn, CAST(monthly AS DOUBLE) AS x FROM raw WHERE monthly IS NOT NULL AND churn IS NOT NULL),"
    " q AS (SELECT churn, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3,"
    " avg(x) AS mean FROM b GROUP BY churn)"
    " SELECT q.churn, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(mean, 6) AS mean,"
    " round(q3 - q1, 6) AS iqr,"
    " round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low,"
    " round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high,"
    " count(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers,"
    " count(*) AS n FROM b JOIN q ON b.churn = q.churn GROUP BY q.churn, q1, median, q3, mean"))
def q_box(spark, d):
    """Box statistics of the monthly charge by label."""
    return r6(profile.box_stats(raw(spark, d), "monthly", "churn"))


@query("feature_means", with_curated(union_all(
    [f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean FROM curated" for c in CURATED_FEATURES])))
def q_feature_means(spark, d):
    """Global mean of every curated feature."""
    cur = etl.curated_from_raw(raw(spark, d))
    return r6(profile.feature_means(cur, CURATED_FEATURES))


# ------------------------------------------------------------------ the same operators on a second labelled table

@query("doc_quality_rate_by_lang",
       "SELECT d.lang, round(100 * avg(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END), 6) AS quality_rate,"
       " count(*) AS doc_count FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IS NOT NULL"
       " GROUP BY d.lang")
def q_doc_quality(spark, d):
    """A9 on documents x labels: positive-label rate by language (label and positive value as parameters)."""
    from churnkit.operators import olap
    docs = adapters.labelled_documents(spark, d)
    return r6(olap.churn_rate_by(docs, "lang", "quality", 1, "quality_rate", "doc_count"))


@query("doc_length_stats_by_label",
       "SELECT 'n_chars' AS feature, l.quality, round(round(avg(n_chars), 2), 6) AS mean,"
       " round(round(median(n_chars), 2), 6) AS median, round(round(stddev_samp(n_chars), 2), 6) AS std,"
       " round(round(CAST(min(n_chars) AS DOUBLE), 2), 6) AS min, round(round(CAST(max(n_chars) AS DOUBLE), 2), 6) AS max"
       " FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE n_chars IS NOT NULL AND l.quality IS NOT NULL"
       " GROUP BY l.quality")
def q_doc_stats(spark, d):
    """A16 on documents x labels: document length by quality label."""
    return r6(profile.stats_by_label(adapters.labelled_documents(spark, d), ["n_chars"], "quality"))


@query("doc_toxic_series",
       "WITH j AS (SELECT d.lang, d.source, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id),"
       " long AS (SELECT 'lang' AS dimension, lang AS value, toxic FROM j UNION ALL"
       " SELECT 'source', source, toxic FROM j)"
       " SELECT dimension, value, round(100 * avg(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 6) AS churn_rate,"
       " count(*) AS customer_count FROM long WHERE value IS NOT NULL GROUP BY dimension, value"
       " UNION ALL SELECT 'all', 'all', round(100 * avg(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 6), count(*) FROM j")
def q_doc_toxic(spark, d):
    """A11 grouping sets on documents x labels: toxic-label rate by language and source in one scan."""
    from churnkit.operators import olap
    docs = adapters.labelled_documents(spark, d)
    return r6(olap.multi_dim_rates(docs, ["lang", "source"], "toxic", 1))
