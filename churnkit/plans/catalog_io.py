"""Catalogue part 6: sources and sinks (E1-E5) as round trips through the
shared checkpoint folder — what is read back must equal what was derived."""

from __future__ import annotations

from churnkit.plans import etl
from churnkit.plans.catalog import query, r6
from churnkit.plans.oracle_sql import with_curated, with_customers
from churnkit.session import scratch_path
from churnkit.sources import adapters, layers

RAW_TEXT_SCHEMA = (
    "customer_id bigint, gender string, senior int, partner string, dependents string, paperless string, "
    "segment string, region string, priority string, tenure int, monthly double, total_text string, "
    "addon_click string, addon_error string, addon_purchase string, addon_signup string, addon_view string, "
    "churn string")


@query("csv_to_raw_layer", with_customers(
    "SELECT customer_id, gender, senior, partner, dependents, paperless, segment, region, priority, tenure,"
    " round(monthly, 6) AS monthly, round(total, 6) AS total, addon_click, addon_error, addon_purchase,"
    " addon_signup, addon_view, churn FROM raw"))
def q_csv_raw(spark, d):
    """E4 -> E1 -> P1/P2: the text table written as headered CSV, read back with a declared
    schema (blanks preserved), then cleaned into the raw layer."""
    path = layers.write_csv(adapters.customer_frame(spark, d), scratch_path(spark, "csv"))
    back = layers.read_csv(spark, path, RAW_TEXT_SCHEMA)
    return r6(adapters.clean_customers(back))


@query("layers_parquet_roundtrip", with_curated(
    "SELECT * REPLACE (round(tenure, 6) AS tenure, round(monthly, 6) AS monthly, round(total, 6) AS total)"
    " FROM curated"))
def q_layers(spark, d):
    """E3 -> E2: raw, staging and curated written as Parquet layers; the curated layer read back."""
    built = etl.build_layers(adapters.raw_customers(spark, d))
    paths = etl.write_layers(spark, built, scratch_path(spark, "layers"))
    return r6(layers.read_parquet(spark, paths["curated"]))


@query("result_table_csv_roundtrip", with_customers(
    ", s AS (SELECT segment, count(*) AS n, round(avg(tenure), 6) AS avg_tenure FROM raw"
    " WHERE segment IS NOT NULL GROUP BY segment) SELECT * FROM s"))
def q_result_csv(spark, d):
    """E4 -> E5: a result table written as CSV and read back with its schema."""
    from pyspark.sql import functions as F
    res = adapters.raw_customers(spark, d).where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.avg("tenure").alias("avg_tenure"))
    path = layers.write_csv(r6(res), scratch_path(spark, "result"))
    return layers.read_csv(spark, path, "segment string, n bigint, avg_tenure double")
