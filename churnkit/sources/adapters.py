"""Adapters that shape the driver's test tables into the churn data model.

The reference works on one flat customer table.  ``customer_frame`` derives
that table from ``customer``, ``orders``, ``nation``, ``region`` and
``events`` with aggregations Spark distributes (partial aggregation before
every shuffle, so a customer holding a third of all orders costs one row
per map task, not a hot reducer).

Mapping (FIXTURES.md section 3):

* key ``customer_id`` = c_custkey
* ``segment`` (contract-like) = c_mktsegment; ``region`` (internet-like) = r_name
* ``priority`` (payment-like) = priority of the latest order (tie -> smallest orderkey)
* ``tenure`` = whole months first order -> snapshot (max order date); 0 without orders
* ``monthly`` = order total / greatest(tenure, 1); ``total_text`` = total as text,
  blank where the customer has no orders or key % 97 = 0
* ``churn`` = 'Yes' when the last order is older than 300 days before the snapshot
* add-on flags per event type: 'Yes' when the user's mean value of that type
  exceeds the overall mean of the type, 'No' otherwise, 'No service' for users
  without events
* demographic stand-ins: gender by key parity, senior = negative balance,
  partner = latest order status 'F', dependents = more than 10 orders,
  paperless = balance above 5000
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.clean import impute_blank
from churnkit.session import stored
from churnkit.sources.tables import read_table

# The event types of the events table, in sorted order.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CHURN_DAYS = 300
BLANK_EVERY = 97


def order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ordering customer: first/last order, total, count, latest order attributes."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority",
                         "o_orderstatus"])
    latest_key = F.struct(F.col("o_orderdate"), (-F.col("o_orderkey")).alias("neg_key"))
    return orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.sum("o_totalprice").alias("order_total"),
        F.count(F.lit(1)).alias("n_orders"),
        F.max_by(F.struct("o_orderpriority", "o_orderstatus"), latest_key).alias("latest"),
    )


def snapshot_date(spark: SparkSession, sf_dir: str):
    """Snapshot = latest order date (one scalar; the scan reads one column)."""
    return read_table(spark, sf_dir, "orders", ["o_orderdate"]).agg(F.max("o_orderdate")).first()[0]


def addon_flags(spark: SparkSession, sf_dir: str, event_types=EVENT_TYPES) -> DataFrame:
    """Per user, one 'Yes'/'No' column per event type."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type", "value"])
    per_user = ev.groupBy("user_id", "event_type").agg(F.avg("value").alias("user_mean"))
    # one row per event type: bounded by the category count
    per_type = ev.groupBy("event_type").agg(F.avg("value").alias("type_mean"))
    flagged = per_user.join(per_type, "event_type").withColumn(
        "above", F.when(F.col("user_mean") > F.col("type_mean"), 1).otherwise(0))
    # each event type is a column of the result: one that has none is an error, not a silent loss
    flagged = flagged.withColumn("above", F.when(F.col("event_type").isin(*event_types), F.col("above")).otherwise(
        F.raise_error(F.concat(F.lit("event type without a column: "), F.col("event_type"))).cast("int")))
    # conditional aggregates on ints keep this a hash aggregate (a string pivot sorts)
    wide = flagged.groupBy("user_id").agg(
        *[F.max(F.when(F.col("event_type") == t, F.col("above"))).alias(f"_a_{t}") for t in event_types])
    return wide.select("user_id", *[F.when(F.col(f"_a_{t}") == 1, "Yes").when(F.col(f"_a_{t}") == 0, "No")
                                    .alias(f"addon_{t}") for t in event_types])


def customer_frame(spark: SparkSession, sf_dir: str, churn_days: int = CHURN_DAYS,
                   blank_every: int = BLANK_EVERY) -> DataFrame:
    """The raw customer table (reference 'raw CSV' shape, total still text)."""
    snap = snapshot_date(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    orders = order_summary(spark, sf_dir)
    flags = addon_flags(spark, sf_dir)

    snap_lit = F.lit(snap)
    months = ((F.year(snap_lit) - F.year("first_order")) * 12 + F.month(snap_lit) - F.month("first_order"))
    tenure = F.coalesce(months, F.lit(0)).cast("int")
    has_orders = F.col("n_orders").isNotNull()
    blank = (~has_orders) | (F.col("c_custkey") % blank_every == 0)
    churn_cut = snap_lit - F.expr(f"INTERVAL {int(churn_days)} DAYS")

    joined = (cust
              .join(geo, cust.c_nationkey == geo.n_nationkey, "left")
              .join(orders, cust.c_custkey == orders.o_custkey, "left")
              .join(flags, cust.c_custkey == flags.user_id, "left"))
    addon_cols = [
        F.when(F.col("user_id").isNull(), F.lit("No service"))
        .otherwise(F.coalesce(F.col(f"addon_{t}"), F.lit("No"))).alias(f"addon_{t}")
        for t in EVENT_TYPES
    ]
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("senior"),
        F.when(F.col("latest.o_orderstatus") == "F", "Yes").otherwise("No").alias("partner"),
        F.when(F.coalesce(F.col("n_orders"), F.lit(0)) > 10, "Yes").otherwise("No").alias("dependents"),
        F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No").alias("paperless"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.col("latest.o_orderpriority").alias("priority"),
        tenure.alias("tenure"),
        (F.coalesce(F.col("order_total"), F.lit(0.0)) / F.greatest(tenure, F.lit(1))).alias("monthly"),
        F.when(blank, F.lit(" ")).otherwise(
            F.col("order_total").cast("decimal(18,2)").cast("string")).alias("total_text"),
        *addon_cols,
        F.when((~has_orders) | (F.col("last_order") < churn_cut), "Yes").otherwise("No").alias("churn"),
    )


def clean_customers(raw: DataFrame, text_col: str = "total_text", fallback: str = "monthly",
                    out: str = "total") -> DataFrame:
    """P1+P2: trim, lenient parse, blank -> fallback column; keeps column order."""
    cols = [impute_blank(text_col, fallback).alias(out) if c == text_col else F.col(c) for c in raw.columns]
    return raw.select(*cols)


_RAW: dict[tuple[str, str], DataFrame] = {}


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_frame cleaned: the raw layer, written once per application and folder.

    ``orders`` and ``events`` are aggregated when the layer is first asked for; every
    later query of the application reads the written table.  The source tables of a
    folder must not change while an application runs.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _RAW:
        _RAW[at] = stored(spark, clean_customers(customer_frame(spark, sf_dir)), "raw-layer")
    return _RAW[at]


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to labels: a second labelled table (quality 0/1)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "n_chars"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return docs.join(labels, "doc_id")


def embedding_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings with the float array as double array (vec_id, embedding, label)."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
