"""Registry entries for features, RFM, churn data sets and as-of lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as M
from ..sources.star import load_star
from ..sources.tables import read_table
from .oracle_star import star

REF = "2000-01-01"
CHURN_REF, CHURN_WINDOW = "2000-01-01", 365


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


def _orders(sp, sf):
    o = read_table(sp, sf, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.to_date("o_orderdate").alias("order_date"))


SPARK = {
    "m1_customer_features": lambda sp, sf: M.customer_features(_a(sp, sf).fact, _a(sp, sf).customers,
                                                               _a(sp, sf).products, REF)
    .withColumn("event_timestamp", F.col("event_timestamp").cast("string")),
    "m2_rfm_scores": lambda sp, sf: M.rfm_scores(M.customer_aggregates(_a(sp, sf).fact, _a(sp, sf).products, REF))
    .select("customer_id", "recency_score", "frequency_score", "monetary_score"),
    "m2_rfm_scores_recent_high": lambda sp, sf: M.rfm_scores(
        M.customer_aggregates(_a(sp, sf).fact, _a(sp, sf).products, REF), "recent_high")
    .select("customer_id", "recency_score"),
    "m5_churn_dataset": lambda sp, sf: M.churn_dataset(_a(sp, sf).fact, _a(sp, sf).customers, _a(sp, sf).products,
                                                       CHURN_REF, CHURN_WINDOW, data_end="2001-08-01"),
    "j13_asof_features": lambda sp, sf: M.asof_join(_orders(sp, sf), M.monthly_customer_snapshots(_a(sp, sf).fact),
                                                    "customer_id", "order_date", "feature_date", 90)
    .withColumn("order_date", F.col("order_date").cast("string"))
    .withColumn("feature_date", F.col("feature_date").cast("string")),
    "j14_latest_snapshot": lambda sp, sf: M.latest_per_entity(M.monthly_customer_snapshots(_a(sp, sf).fact),
                                                              "customer_id", "feature_date")
    .withColumn("feature_date", F.col("feature_date").cast("string")),
}

_AGG = """
agg AS (
  SELECT f.customer_id,
         CAST(DATE '{ref}' - MAX(f.order_date) AS BIGINT) AS days_since_last_purchase,
         COUNT(*) FILTER (WHERE f.order_date >= DATE '{ref}' - INTERVAL 90 DAY) AS total_orders_90d,
         COUNT(*) AS total_orders_all_time,
         CAST(SUM(f.final_amount_inr) FILTER (WHERE f.order_date >= DATE '{ref}' - INTERVAL 180 DAY) AS DOUBLE)
           / COUNT(f.final_amount_inr) FILTER (WHERE f.order_date >= DATE '{ref}' - INTERVAL 180 DAY)
           AS avg_order_value_last_6m,
         CAST(SUM(f.final_amount_inr) AS DOUBLE) / COUNT(f.final_amount_inr) AS avg_order_value_all_time,
         CAST(SUM(f.final_amount_inr) AS DOUBLE) AS total_spend_all_time,
         COALESCE(MIN(p.category), 'Unknown') AS preferred_category,
         COUNT(DISTINCT p.subcategory) AS unique_categories_purchased,
         CAST(SUM(CASE WHEN f.return_status = 'Returned' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)
           AS return_rate_historical
  FROM fact_all f {join} JOIN dim_products p ON f.product_id = p.product_id
  WHERE f.order_date < DATE '{ref}' GROUP BY f.customer_id)"""


def _pct(col, desc=False):
    o = f"{col} DESC" if desc else col
    return (f"(RANK() OVER (ORDER BY {o}) + (COUNT(*) OVER (PARTITION BY {col}) - 1) / 2.0) / COUNT(*) OVER ()")


def _bin(x):
    return (f"CASE WHEN {x} <= 0.2 THEN 1 WHEN {x} <= 0.4 THEN 2 WHEN {x} <= 0.6 THEN 3 "
            f"WHEN {x} <= 0.8 THEN 4 ELSE 5 END")


_SCORES = f"""
sc AS (SELECT *, 6 - {_bin('pr')} AS recency_score, {_bin('pf')} AS frequency_score, {_bin('pm')} AS monetary_score
       FROM (SELECT *, {_pct('days_since_last_purchase', desc=True)} AS pr, {_pct('total_orders_all_time')} AS pf,
                    {_pct('total_spend_all_time')} AS pm FROM base))"""

_SEG = """CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champion'
     WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Loyal'
     WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New'
     WHEN recency_score <= 2 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'At Risk'
     WHEN recency_score <= 2 AND frequency_score <= 2 AND monetary_score <= 2 THEN 'Lost'
     WHEN monetary_score >= 4 AND frequency_score <= 2 THEN 'High Value Occasional' ELSE 'Potential' END"""

RAW = {
    "m1_customer_features": "WITH " + _AGG.format(ref=REF, join="") + """,
base AS (SELECT a.customer_id, a.days_since_last_purchase, a.total_orders_90d, a.total_orders_all_time,
                COALESCE(a.avg_order_value_last_6m, a.avg_order_value_all_time) AS avg_order_value_last_6m,
                a.avg_order_value_all_time, a.total_spend_all_time, a.preferred_category,
                a.unique_categories_purchased, a.return_rate_historical,
                COALESCE(c.is_prime_member, FALSE) AS is_prime_member,
                CAST(TIMESTAMP '""" + REF + """ 00:00:00' AS VARCHAR) AS event_timestamp
         FROM agg a JOIN dim_customers c ON a.customer_id = c.customer_id),""" + _SCORES + f"""
SELECT customer_id, days_since_last_purchase, total_orders_90d, total_orders_all_time, avg_order_value_last_6m,
       avg_order_value_all_time, total_spend_all_time, preferred_category, unique_categories_purchased,
       return_rate_historical, is_prime_member, event_timestamp, CAST(recency_score AS INTEGER) AS recency_score,
       CAST(frequency_score AS INTEGER) AS frequency_score, CAST(monetary_score AS INTEGER) AS monetary_score,
       {_SEG} AS rfm_segment FROM sc""",
    "m2_rfm_scores": "WITH " + _AGG.format(ref=REF, join="") + ", base AS (SELECT * FROM agg)," + _SCORES + """
SELECT customer_id, CAST(recency_score AS INTEGER) AS recency_score, CAST(frequency_score AS INTEGER) AS frequency_score,
       CAST(monetary_score AS INTEGER) AS monetary_score FROM sc""",
    "m2_rfm_scores_recent_high": "WITH " + _AGG.format(ref=REF, join="") + f""", base AS (SELECT * FROM agg)
SELECT customer_id, CAST(6 - {_bin(_pct('days_since_last_purchase'))} AS INTEGER) AS recency_score FROM base""",
    "m5_churn_dataset": "WITH " + _AGG.format(ref=CHURN_REF, join="LEFT") + f""",
lw AS (SELECT DISTINCT customer_id FROM fact_all
       WHERE order_date >= DATE '{CHURN_REF}' AND order_date < DATE '{CHURN_REF}' + INTERVAL {CHURN_WINDOW} DAY)
SELECT a.customer_id, a.days_since_last_purchase, a.total_orders_90d, a.total_orders_all_time,
       COALESCE(a.avg_order_value_last_6m, a.avg_order_value_all_time) AS avg_order_value_last_6m,
       a.avg_order_value_all_time, a.total_spend_all_time, a.preferred_category, a.unique_categories_purchased,
       a.return_rate_historical, COALESCE(CAST(c.is_prime_member AS INTEGER), 0) AS is_prime_member,
       CASE WHEN l.customer_id IS NULL THEN 1 ELSE 0 END AS churned
FROM agg a JOIN dim_customers c ON a.customer_id = c.customer_id LEFT JOIN lw l ON a.customer_id = l.customer_id""",
    "j13_asof_features": """
WITH snap AS (SELECT customer_id, last_day(date_trunc('month', order_date)) AS feature_date,
                     CAST(SUM(final_amount_inr) AS DOUBLE) AS month_spend, COUNT(*) AS month_orders
              FROM fact_all GROUP BY customer_id, date_trunc('month', order_date)),
e AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date FROM orders),
j AS (SELECT e.*, s.feature_date, s.month_spend, s.month_orders,
             ROW_NUMBER() OVER (PARTITION BY e.order_id, e.customer_id, e.order_date ORDER BY s.feature_date DESC) AS rn
      FROM e LEFT JOIN snap s ON e.customer_id = s.customer_id AND s.feature_date <= e.order_date
                                AND s.feature_date >= e.order_date - INTERVAL 90 DAY)
SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(CAST(feature_date AS DATE) AS VARCHAR)
       AS feature_date, month_spend, month_orders FROM j WHERE rn = 1""",
    "j14_latest_snapshot": """
WITH snap AS (SELECT customer_id, last_day(date_trunc('month', order_date)) AS feature_date,
                     CAST(SUM(final_amount_inr) AS DOUBLE) AS month_spend, COUNT(*) AS month_orders
              FROM fact_all GROUP BY customer_id, date_trunc('month', order_date))
SELECT customer_id, CAST(CAST(feature_date AS DATE) AS VARCHAR) AS feature_date, month_spend, month_orders
FROM snap QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY feature_date DESC) = 1""",
}

ORACLE = {k: star(v) for k, v in RAW.items()}
