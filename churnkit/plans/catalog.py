"""Catalogue of named queries over the driver's test tables.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL | None)``.
The SQL runs in DuckDB on the same Parquet files and must produce the same
columns (names, types) and values; doubles are rounded to 6 places on both
sides because summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from churnkit.operators import filters, olap
from churnkit.plans import etl
from churnkit.plans.oracle_sql import with_curated, with_customers, with_staging
from churnkit.sources import adapters

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

# Fixed values for the test tables: cohort edges fitted to their tenure and
# charge ranges (tenure quartiles 69/74/77 months; charges in the tens of
# thousands), the payment token and the category levels.
T_TENURE_EDGES = (0, 61, 69, 74, 80)
T_TENURE_LABELS = ("0-61 mo", "62-69 mo", "70-74 mo", "75-80 mo")
T_CHARGE_EDGES = (0, 20000, 30000, 40000, float("inf"))
T_CHARGE_LABELS = ("$0-20k", "$20k-30k", "$30k-40k", "$40k+")
T_AUTO_TOKEN = "urgent"
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
BIN_KW = dict(tenure_edges=T_TENURE_EDGES, tenure_labels=T_TENURE_LABELS, charge_edges=T_CHARGE_EDGES,
              charge_labels=T_CHARGE_LABELS, auto_token=T_AUTO_TOKEN)


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (output-only; never inside a computation)."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def raw(spark, d):
    return adapters.raw_customers(spark, d)


# SQL fragments shared by the oracle strings
RATE = "100 * avg(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)"
TENURE_BINS = ("CASE WHEN tenure >= 0 AND tenure <= 61 THEN '0-61 mo' WHEN tenure > 61 AND tenure <= 69 THEN "
               "'62-69 mo' WHEN tenure > 69 AND tenure <= 74 THEN '70-74 mo' WHEN tenure > 74 AND tenure <= 80 "
               "THEN '75-80 mo' END")
CHARGE_BINS = ("CASE WHEN monthly > 0 AND monthly <= 20000 THEN '$0-20k' WHEN monthly > 20000 AND monthly <= 30000 "
               "THEN '$20k-30k' WHEN monthly > 30000 AND monthly <= 40000 THEN '$30k-40k' WHEN monthly > 40000 "
               "THEN '$40k+' END")
PAY_TYPE = ("CASE WHEN contains(lower(priority), 'urgent') THEN 'Auto-pay' WHEN priority IS NOT NULL "
            "THEN 'Manual' END")


# ---------------------------------------------------------------- layers (E, P)

@query("raw_layer", with_customers(
    "SELECT customer_id, gender, senior, partner, dependents, paperless, segment, region, priority, tenure,"
    " round(monthly, 6) AS monthly, round(total, 6) AS total, addon_click, addon_error, addon_purchase,"
    " addon_signup, addon_view, churn FROM raw"))
def q_raw_layer(spark, d):
    """P1, P2 over the adapter: the cleaned raw layer."""
    return r6(raw(spark, d))


@query("raw_text_audit", with_customers(
    "SELECT count(*) AS n_rows, CAST(sum(CASE WHEN trim(total_text) = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank,"
    " CAST(sum(CASE WHEN TRY_CAST(trim(total_text) AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unparsed"
    " FROM cust_text"))
def q_raw_text_audit(spark, d):
    """Blanks and unparseable text before imputation."""
    from churnkit.functions.clean import is_blank, lenient_double
    t = adapters.customer_frame(spark, d)
    return t.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.when(is_blank("total_text"), 1).otherwise(0)).cast("long").alias("n_blank"),
                 F.sum(F.when(lenient_double("total_text").isNull(), 1).otherwise(0)).cast("long").alias("n_unparsed"))


@query("staging_layer", with_staging("SELECT * REPLACE (round(monthly, 6) AS monthly, round(total, 6) AS total)"
                                     " FROM staging"))
def q_staging_layer(spark, d):
    """Encodings and one-hot columns."""
    return r6(etl.staging_layer(raw(spark, d)))


@query("curated_layer", with_curated("SELECT * REPLACE (round(tenure, 6) AS tenure, round(monthly, 6) AS monthly,"
                                     " round(total, 6) AS total) FROM curated"))
def q_curated_layer(spark, d):
    """Population z-scores, key retained."""
    return r6(etl.curated_from_raw(raw(spark, d)))


# ---------------------------------------------------------------- OLAP

def _rate_sql(dim_expr: str, name: str, src: str = "raw") -> str:
    return with_customers(
        f"SELECT {name}, round({RATE}, 6) AS churn_rate, count(*) AS customer_count FROM "
        f"(SELECT *, {dim_expr} AS {name} FROM {src}) WHERE {name} IS NOT NULL GROUP BY {name}")


@query("churn_rate_by_segment", _rate_sql("segment", "segment"))
def q_rate_segment(spark, d):
    """A9 on the contract-like dimension."""
    return r6(olap.churn_rate_by(raw(spark, d), "segment"))


@query("churn_rate_by_priority", _rate_sql("priority", "priority"))
def q_rate_priority(spark, d):
    """A9 on the payment-like dimension (NULL priority dropped)."""
    return r6(olap.churn_rate_by(raw(spark, d), "priority"))


@query("churn_rate_by_region", _rate_sql("region", "region"))
def q_rate_region(spark, d):
    """A9 on the internet-like dimension."""
    return r6(olap.churn_rate_by(raw(spark, d), "region"))


@query("churn_rate_by_tenure_cohort", _rate_sql(TENURE_BINS, "tenure_cohort"))
def q_rate_tenure(spark, d):
    """P10 + A9."""
    return r6(olap.churn_rate_by(olap.olap_frame(raw(spark, d), **BIN_KW), "tenure_cohort"))


@query("churn_rate_by_charge_cohort", _rate_sql(CHARGE_BINS, "charge_cohort"))
def q_rate_charge(spark, d):
    """P11 + A9 (charge 0 falls outside every cohort)."""
    return r6(olap.churn_rate_by(olap.olap_frame(raw(spark, d), **BIN_KW), "charge_cohort"))


@query("churn_rate_by_pay_type", _rate_sql(PAY_TYPE, "pay_type"))
def q_rate_paytype(spark, d):
    """P12 + A9."""
    return r6(olap.churn_rate_by(olap.olap_frame(raw(spark, d), **BIN_KW), "pay_type"))


@query("churn_rate_by_paperless", _rate_sql("paperless", "paperless"))
def q_rate_paperless(spark, d):
    """A9 on a binary billing dimension."""
    return r6(olap.churn_rate_by(raw(spark, d), "paperless"))


@query("label_distribution_by_segment", with_customers(
    "SELECT segment, churn, round(n * 100.0 / sum(n) OVER (PARTITION BY segment), 6) AS pct, n FROM "
    "(SELECT segment, churn, count(*) AS n FROM raw WHERE segment IS NOT NULL AND churn IS NOT NULL "
    "GROUP BY segment, churn)"))
def q_label_dist(spark, d):
    """A10: label distribution inside each group."""
    return r6(olap.label_distribution(raw(spark, d), "segment"))


def _olap_series_sql(where: str = "") -> str:
    dims = [("segment", "segment"), ("tenure_cohort", TENURE_BINS), ("priority", "priority"),
            ("region", "region"), ("charge_cohort", CHARGE_BINS), ("pay_type", PAY_TYPE)]
    parts = []
    for name, expr in dims:
        parts.append(f"SELECT '{name}' AS dimension, CAST({expr} AS VARCHAR) AS value, churn FROM f")
    union = " UNION ALL ".join(parts)
    return with_customers(
        f", f AS (SELECT * FROM raw {where}), long AS ({union}) "
        f"SELECT dimension, value, round({RATE}, 6) AS churn_rate, count(*) AS customer_count FROM long "
        "WHERE value IS NOT NULL GROUP BY dimension, value "
        f"UNION ALL SELECT 'all', 'all', round({RATE}, 6), count(*) FROM f")


@query("olap_series", _olap_series_sql())
def q_olap_series(spark, d):
    """Six series in one grouping-sets scan + overall row."""
    return r6(olap.olap_series(raw(spark, d), **BIN_KW))


@query("olap_series_focus", _olap_series_sql("WHERE region = 'ASIA'"))
def q_olap_series_focus(spark, d):
    """A11 under a focus slice."""
    return r6(olap.olap_series(raw(spark, d), focus_col="region", focus_val="ASIA", **BIN_KW))


@query("crosstab_segment_region", with_customers(
    "SELECT segment, " + ", ".join(
        f"round(round(100 * avg(CASE WHEN region = '{r}' THEN (CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END) END), 1), 6)"
        f" AS {r.replace(' ', '_')}" for r in REGIONS) +
    " FROM raw WHERE segment IS NOT NULL GROUP BY segment"))
def q_crosstab(spark, d):
    """Pivot segment x region, 1 dp, empty cell NULL (R2)."""
    return r6(olap.crosstab(raw(spark, d), "segment", "region", REGIONS))


@query("crosstab_peak", with_customers(
    f"SELECT segment, region, round(round({RATE}, 1), 6) AS peak_rate FROM raw "
    "WHERE segment IS NOT NULL AND region IS NOT NULL GROUP BY segment, region "
    "ORDER BY peak_rate DESC, segment, region LIMIT 1"))
def q_crosstab_peak(spark, d):
    """Highest cell of the cross-tab."""
    return r6(olap.crosstab_peak(raw(spark, d), "segment", "region"))


@query("kpi_filtered", with_customers(
    "SELECT count(*) FILTER (WHERE sel) AS n,"
    " round(coalesce(avg(CASE WHEN sel THEN (CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END) END), 0) * 100, 6) AS churn_rate,"
    " round(coalesce(avg(CASE WHEN sel THEN monthly END), 0), 6) AS avg_charge,"
    " round(coalesce(avg(CASE WHEN sel THEN tenure END), 0), 6) AS avg_tenure,"
    " count(*) FILTER (WHERE sel) - count(*) AS delta_n,"
    " round((coalesce(avg(CASE WHEN sel THEN (CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END) END), 0)"
    "   - avg(CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END)) * 100, 6) AS delta_churn_pp,"
    " round(coalesce(avg(CASE WHEN sel THEN monthly END), 0) - avg(monthly), 6) AS delta_charge,"
    " round(coalesce(avg(CASE WHEN sel THEN tenure END), 0) - avg(tenure), 6) AS delta_tenure"
    " FROM (SELECT *, coalesce(segment IN ('AUTOMOBILE', 'MACHINERY') AND region IN ('ASIA') AND senior = 0, false)"
    " AS sel FROM raw)"))
def q_kpi_filtered(spark, d):
    """A14 with the shared readable filter F1 (segment IN, region IN, non-senior)."""
    df = raw(spark, d)
    sel = (F.col("segment").isin("AUTOMOBILE", "MACHINERY") & F.col("region").isin("ASIA")
           & (F.col("senior") == 0))
    return r6(olap.kpi_row(df, F.coalesce(sel, F.lit(False))))


@query("filtered_rates", _rate_sql("segment", "segment").replace(
    "FROM raw)", "FROM raw WHERE segment IN ('AUTOMOBILE', 'MACHINERY') AND region IN ('ASIA') AND senior = 0)"))
def q_filtered_rates(spark, d):
    """F1 applied before A9: the dashboard's filtered view."""
    df = filters.readable_filter(raw(spark, d), {"segment": ["AUTOMOBILE", "MACHINERY"], "region": ["ASIA"],
                                                 "priority": []}, "senior", "Non-Senior")
    return r6(olap.churn_rate_by(df, "segment"))


@query("demographic_rates", with_customers(
    ", seg AS (SELECT 'gender' AS dimension, gender AS segment, churn FROM raw"
    " UNION ALL SELECT 'senior', CASE WHEN senior = 1 THEN 'Senior' WHEN senior = 0 THEN 'Non-Senior' END, churn FROM raw"
    " UNION ALL SELECT 'partner', CASE WHEN partner = 'Yes' THEN 'Has Partner' WHEN partner = 'No' THEN 'No Partner' END,"
    " churn FROM raw"
    " UNION ALL SELECT 'dependents', CASE WHEN dependents = 'Yes' THEN 'Has Dependents' WHEN dependents = 'No'"
    " THEN 'No Dependents' END, churn FROM raw) "
    f"SELECT segment, dimension, round({RATE}, 6) AS churn_rate, count(*) AS customer_count FROM seg"
    " WHERE segment IS NOT NULL GROUP BY segment, dimension"
    f" UNION ALL SELECT 'Overall', 'Overall', round({RATE}, 6), count(*) FROM raw"))
def q_demographic(spark, d):
    """Grouping sets over four demographic columns + overall."""
    return r6(olap.demographic_rates(raw(spark, d)))


ADDONS = ("addon_click", "addon_error", "addon_purchase", "addon_signup", "addon_view")


@query("addon_adoption", with_customers(
    "SELECT churn, " + ", ".join(
        f"round(avg(CASE WHEN {a} = 'Yes' THEN 1 ELSE 0 END) * 100, 6) AS {a}" for a in ADDONS) +
    " FROM raw WHERE churn IS NOT NULL GROUP BY churn"))
def q_addon_adoption(spark, d):
    """Add-on adoption (%) by label."""
    return r6(olap.addon_adoption(raw(spark, d), ADDONS))


@query("service_count_rates", with_customers(
    "SELECT CAST(" + " + ".join(f"(CASE WHEN {a} = 'Yes' THEN 1 ELSE 0 END)" for a in ADDONS) +
    f" AS INTEGER) AS service_count, round({RATE}, 6) AS churn_rate, count(*) AS customer_count FROM raw"
    " GROUP BY 1"))
def q_service_count(spark, d):
    """P13 + A20."""
    return r6(olap.service_count_rates(raw(spark, d), ADDONS))


PARTS = ("churnkit.plans.catalog_profile", "churnkit.plans.catalog_eval", "churnkit.plans.catalog_segments",
         "churnkit.plans.catalog_models", "churnkit.plans.catalog_neighbours", "churnkit.plans.catalog_io")


def _load() -> None:
    import importlib
    for mod in PARTS:
        importlib.import_module(mod)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
