"""Registry entries for loading the star (K1-K5, K9) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import loading as L
from ..sources.star import dim_time, load_star
from ..sources.tables import read_table
from .oracle_star import star

LINE = ["transaction_id", "line_number", "product_id", "supplier_id"]
FACT = ["order_date", "customer_id", "final_amount_inr", "payment_method", "order_year"]


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


def _orders_upsert(sp, sf):
    """Orders before 1999 are there; those from 1998 on arrive, 1998 a second time with another status."""
    o = read_table(sp, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    day = lambda d: F.lit(f"{d} 00:00:00").cast("timestamp")
    old = o.where(F.col("o_orderdate") < day("1999-01-01"))
    new = o.where(F.col("o_orderdate") >= day("1998-01-01")).withColumn("o_orderstatus", F.lit("N"))
    return L.upsert(old, new, ["o_orderkey"], ["o_orderdate"]).drop("o_orderdate")


def _fact_upsert(sp, sf):
    """Lines of 1995 to 1998 are there; those from 1998 on arrive with the amount doubled."""
    f = _a(sp, sf).fact.select(*LINE, *FACT)
    new = f.where(F.col("order_date") >= F.lit("1998-01-01").cast("date")).withColumn(
        "final_amount_inr", F.col("final_amount_inr") * 2)
    old = f.where(F.col("order_date") < F.lit("1999-01-01").cast("date"))
    out = L.upsert(old.withColumn("final_amount_inr", F.col("final_amount_inr").cast("double")),
                   new.withColumn("final_amount_inr", F.col("final_amount_inr").cast("double")), LINE, ["final_amount_inr"])
    return out.withColumn("order_date", F.col("order_date").cast("string"))


def _customers(sp, sf):
    s = _a(sp, sf)
    sales = s.fact.select("customer_id", "order_date", *LINE, "payment_method", "delivery_type").join(
        s.customers.select("customer_id", "customer_state", "customer_tier"), "customer_id")
    return L.load_customers(sales, ["order_date", *LINE], ["customer_state", "customer_tier", "payment_method", "delivery_type"])


def _time(sp, sf):
    return L.with_sentinel(dim_time(_a(sp, sf).fact)).withColumn("date_id", F.col("date_id").cast("string"))


SPARK = {
    "k1_upsert_orders": _orders_upsert,
    "k2_load_customers": _customers,
    "k3_load_products": lambda sp, sf: L.load_products(_a(sp, sf).products, ["product_name"]),
    "k4_dim_time": lambda sp, sf: dim_time(_a(sp, sf).fact).withColumn("date_id", F.col("date_id").cast("string")),
    "k5_upsert_facts": _fact_upsert,
    "k9_time_with_sentinel": _time,
}

_TIME = """
SELECT DISTINCT CAST(order_date AS VARCHAR) AS date_id, CAST(day(order_date) AS INTEGER) AS day, order_month AS month,
       order_quarter AS quarter, order_year AS year, isodow(order_date) >= 6 AS is_weekend, FALSE AS is_festival,
       CAST(NULL AS VARCHAR) AS festival_name FROM fact_all WHERE order_year > 1900"""

ORACLE = {
    "k1_upsert_orders": """
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) >= 1998 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders""",
    "k2_load_customers": star("""
SELECT f.customer_id, c.customer_state, c.customer_tier, f.payment_method, f.delivery_type
FROM fact_all f JOIN dim_customers c ON f.customer_id = c.customer_id
QUALIFY ROW_NUMBER() OVER (PARTITION BY f.customer_id ORDER BY f.order_date, f.transaction_id, f.line_number, f.product_id,
                           f.supplier_id) = 1"""),
    "k3_load_products": star("""
SELECT product_id, product_name, category, subcategory, brand, base_price_2015, weight_kg, is_prime_eligible, launch_year
FROM dim_products"""),
    "k4_dim_time": star(_TIME),
    # rows that are there stay as they are, even twice; of those that arrive there is one per key
    "k5_upsert_facts": star("""
WITH f AS (SELECT transaction_id, line_number, product_id, supplier_id, CAST(order_date AS VARCHAR) AS order_date, customer_id,
                  CAST(final_amount_inr AS DOUBLE) AS final_amount_inr, payment_method, order_year FROM fact_all)
SELECT * FROM f WHERE order_year < 1998
UNION ALL SELECT transaction_id, line_number, product_id, supplier_id, order_date, customer_id, MAX(2 * final_amount_inr), payment_method,
       order_year FROM f WHERE order_year >= 1998 GROUP BY ALL"""),
    "k9_time_with_sentinel": star(_TIME + """
UNION ALL SELECT '1900-01-01', 1, 1, 1, 1900, FALSE, FALSE, CAST(NULL AS VARCHAR)"""),
}
