"""DuckDB SQL for the customer data model — the independent oracle.

The CTE chain mirrors ``churnkit.sources.adapters`` rule by rule, written
directly in SQL (no shared code with the Spark side).
"""

from __future__ import annotations

CUSTOMER_CTE = """
snap AS (SELECT max(o_orderdate) AS snapshot FROM orders),
ord AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
         sum(o_totalprice) AS order_total, count(*) AS n_orders
  FROM orders GROUP BY o_custkey),
latest AS (
  SELECT o_custkey, o_orderpriority AS latest_priority, o_orderstatus AS latest_status FROM (
    SELECT o_custkey, o_orderpriority, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey ASC) AS rn
    FROM orders) WHERE rn = 1),
ev_type AS (SELECT event_type, avg(value) AS type_mean FROM events GROUP BY event_type),
ev_user AS (SELECT user_id, event_type, avg(value) AS user_mean FROM events GROUP BY user_id, event_type),
flags AS (
  SELECT u.user_id,
    max(CASE WHEN u.event_type = 'click' THEN CASE WHEN u.user_mean > t.type_mean THEN 'Yes' ELSE 'No' END END) AS f_click,
    max(CASE WHEN u.event_type = 'error' THEN CASE WHEN u.user_mean > t.type_mean THEN 'Yes' ELSE 'No' END END) AS f_error,
    max(CASE WHEN u.event_type = 'purchase' THEN CASE WHEN u.user_mean > t.type_mean THEN 'Yes' ELSE 'No' END END) AS f_purchase,
    max(CASE WHEN u.event_type = 'signup' THEN CASE WHEN u.user_mean > t.type_mean THEN 'Yes' ELSE 'No' END END) AS f_signup,
    max(CASE WHEN u.event_type = 'view' THEN CASE WHEN u.user_mean > t.type_mean THEN 'Yes' ELSE 'No' END END) AS f_view
  FROM ev_user u JOIN ev_type t ON u.event_type = t.event_type GROUP BY u.user_id),
cust_base AS (
  SELECT c.c_custkey, c.c_acctbal, c.c_mktsegment, r.r_name,
         o.first_order, o.last_order, o.order_total, o.n_orders, l.latest_priority, l.latest_status,
         f.user_id AS ev_user, f.f_click, f.f_error, f.f_purchase, f.f_signup, f.f_view, s.snapshot,
         CAST(coalesce((year(s.snapshot) - year(o.first_order)) * 12 + month(s.snapshot) - month(o.first_order), 0) AS INTEGER) AS tenure_m
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN ord o ON c.c_custkey = o.o_custkey
  LEFT JOIN latest l ON c.c_custkey = l.o_custkey
  LEFT JOIN flags f ON c.c_custkey = f.user_id
  CROSS JOIN snap s),
cust_text AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS senior,
    CASE WHEN latest_status = 'F' THEN 'Yes' ELSE 'No' END AS partner,
    CASE WHEN coalesce(n_orders, 0) > 10 THEN 'Yes' ELSE 'No' END AS dependents,
    CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS paperless,
    c_mktsegment AS segment, r_name AS region, latest_priority AS priority,
    tenure_m AS tenure,
    coalesce(order_total, 0.0) / greatest(tenure_m, 1) AS monthly,
    CASE WHEN n_orders IS NULL OR c_custkey % 97 = 0 THEN ' '
         ELSE CAST(CAST(order_total AS DECIMAL(18,2)) AS VARCHAR) END AS total_text,
    CASE WHEN ev_user IS NULL THEN 'No service' ELSE coalesce(f_click, 'No') END AS addon_click,
    CASE WHEN ev_user IS NULL THEN 'No service' ELSE coalesce(f_error, 'No') END AS addon_error,
    CASE WHEN ev_user IS NULL THEN 'No service' ELSE coalesce(f_purchase, 'No') END AS addon_purchase,
    CASE WHEN ev_user IS NULL THEN 'No service' ELSE coalesce(f_signup, 'No') END AS addon_signup,
    CASE WHEN ev_user IS NULL THEN 'No service' ELSE coalesce(f_view, 'No') END AS addon_view,
    CASE WHEN n_orders IS NULL OR last_order < snapshot - INTERVAL 300 DAY THEN 'Yes' ELSE 'No' END AS churn
  FROM cust_base),
raw AS (
  SELECT customer_id, gender, senior, partner, dependents, paperless, segment, region, priority, tenure, monthly,
    CASE WHEN trim(total_text) = '' THEN monthly ELSE TRY_CAST(trim(total_text) AS DOUBLE) END AS total,
    addon_click, addon_error, addon_purchase, addon_signup, addon_view, churn
  FROM cust_text)"""

# Staging layer: 0/1 encodings and one-hot columns (levels of the test tables).
STAGING_CTE = CUSTOMER_CTE + """,
staging AS (
  SELECT customer_id,
    CAST(CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS INTEGER) AS gender,
    senior,
    CAST(CASE partner WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS partner,
    CAST(CASE dependents WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS dependents,
    CAST(CASE paperless WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS paperless,
    tenure, monthly, total,
    CAST(CASE addon_click WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No service' THEN 0 END AS INTEGER) AS addon_click,
    CAST(CASE addon_error WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No service' THEN 0 END AS INTEGER) AS addon_error,
    CAST(CASE addon_purchase WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No service' THEN 0 END AS INTEGER) AS addon_purchase,
    CAST(CASE addon_signup WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No service' THEN 0 END AS INTEGER) AS addon_signup,
    CAST(CASE addon_view WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No service' THEN 0 END AS INTEGER) AS addon_view,
    CAST(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS churn,
    CAST(CASE WHEN segment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS INTEGER) AS segment_AUTOMOBILE,
    CAST(CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS INTEGER) AS segment_BUILDING,
    CAST(CASE WHEN segment = 'FURNITURE' THEN 1 ELSE 0 END AS INTEGER) AS segment_FURNITURE,
    CAST(CASE WHEN segment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS INTEGER) AS segment_HOUSEHOLD,
    CAST(CASE WHEN segment = 'MACHINERY' THEN 1 ELSE 0 END AS INTEGER) AS segment_MACHINERY,
    CAST(CASE WHEN region = 'AFRICA' THEN 1 ELSE 0 END AS INTEGER) AS region_AFRICA,
    CAST(CASE WHEN region = 'AMERICA' THEN 1 ELSE 0 END AS INTEGER) AS region_AMERICA,
    CAST(CASE WHEN region = 'ASIA' THEN 1 ELSE 0 END AS INTEGER) AS region_ASIA,
    CAST(CASE WHEN region = 'EUROPE' THEN 1 ELSE 0 END AS INTEGER) AS region_EUROPE,
    CAST(CASE WHEN region = 'MIDDLE EAST' THEN 1 ELSE 0 END AS INTEGER) AS region_MIDDLE_EAST,
    CAST(CASE WHEN priority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS priority_1_URGENT,
    CAST(CASE WHEN priority = '2-HIGH' THEN 1 ELSE 0 END AS INTEGER) AS priority_2_HIGH,
    CAST(CASE WHEN priority = '3-MEDIUM' THEN 1 ELSE 0 END AS INTEGER) AS priority_3_MEDIUM,
    CAST(CASE WHEN priority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS INTEGER) AS priority_4_NOT_SPECIFIED,
    CAST(CASE WHEN priority = '5-LOW' THEN 1 ELSE 0 END AS INTEGER) AS priority_5_LOW
  FROM raw)"""

# Curated layer: z-scores with population std (std 0 -> divide by 1), key kept.
CURATED_CTE = STAGING_CTE + """,
scale AS (
  SELECT avg(tenure) AS mt, stddev_pop(tenure) AS st, avg(monthly) AS mm, stddev_pop(monthly) AS sm,
         avg(total) AS mc, stddev_pop(total) AS sc FROM staging),
curated AS (
  SELECT s.* REPLACE (
      (s.tenure - k.mt) / CASE WHEN k.st = 0 OR k.st IS NULL THEN 1 ELSE k.st END AS tenure,
      (s.monthly - k.mm) / CASE WHEN k.sm = 0 OR k.sm IS NULL THEN 1 ELSE k.sm END AS monthly,
      (s.total - k.mc) / CASE WHEN k.sc = 0 OR k.sc IS NULL THEN 1 ELSE k.sc END AS total)
  FROM staging s CROSS JOIN scale k)"""


def with_customers(body: str) -> str:
    return "WITH " + CUSTOMER_CTE + "\n" + body


def with_staging(body: str) -> str:
    return "WITH " + STAGING_CTE + "\n" + body


def with_curated(body: str) -> str:
    return "WITH " + CURATED_CTE + "\n" + body
