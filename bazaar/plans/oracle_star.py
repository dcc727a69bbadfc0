"""The star mapping of FIXTURES.md part C written as DuckDB SQL.

This is the independent oracle side: the Spark side builds the same views with
the DataFrame API in ``bazaar.sources.star``.  Every oracle query is
``STAR_CTE + <query over fact_transactions / dim_products / dim_customers>``.
"""

from __future__ import annotations

_FACT_ALL = """
fact_all AS (
  SELECT
    l.l_orderkey AS transaction_id,
    l.l_linenumber AS line_number,
    o.o_custkey AS customer_id,
    l.l_partkey AS product_id,
    l.l_suppkey AS supplier_id,
    CAST(o.o_orderdate AS DATE) AS order_date,
    CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
    CAST(month(o.o_orderdate) AS INTEGER) AS order_month,
    CAST(quarter(o.o_orderdate) AS INTEGER) AS order_quarter,
    l.l_extendedprice / l.l_quantity AS original_price_inr,
    CAST(l.l_discount AS DECIMAL(3,2)) * 100 AS discount_percent,
    l.l_extendedprice / l.l_quantity * (CAST(1.0 AS DOUBLE) - l.l_discount) AS discounted_price_inr,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST(l.l_extendedprice AS DECIMAL(12,2)) AS mrp_inr,
    CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(3,2))) AS subtotal_inr,
    CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(3,2)))
      * (1 + CAST(l.l_tax AS DECIMAL(3,2))) AS final_amount_inr,
    CASE substr(o.o_orderpriority, 1, 1)
      WHEN '1' THEN 'UPI' WHEN '2' THEN 'Credit Card' WHEN '3' THEN 'COD'
      WHEN '4' THEN 'Net Banking' WHEN '5' THEN 'BNPL' END AS payment_method,
    CAST((((CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) % 16) + 16) % 16 AS DOUBLE) AS delivery_days,
    CASE WHEN (((CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) % 16) + 16) % 16 = 0 THEN 'Same Day'
         WHEN (((CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) % 16) + 16) % 16 <= 2 THEN 'Express'
         ELSE 'Standard' END AS delivery_type,
    CASE WHEN l.l_returnflag = 'R' THEN 'Returned' ELSE 'Not Returned' END AS return_status,
    CASE WHEN l.l_linenumber = 3 THEN NULL
         ELSE CAST(1 + (l.l_orderkey % 9) / 2 AS DECIMAL(2,1)) END AS customer_rating,
    month(o.o_orderdate) IN (10, 11, 1) AS is_festival_sale,
    CASE month(o.o_orderdate) WHEN 10 THEN 'Navratri' WHEN 11 THEN 'Diwali' WHEN 1 THEN 'Republic Day' END AS festival_name,
    CASE WHEN month(o.o_orderdate) IN (10, 11, 1) THEN 'festival' ELSE 'normal' END AS sale_type,
    CAST(1 + (l.l_partkey % 41) / 10 AS DECIMAL(2,1)) AS product_rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

_DIMS = """
dim_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, 'Electronics' AS category,
         p_type AS subcategory, p_brand AS brand, p_retailprice AS base_price_2015,
         p_size / 10.0 AS weight_kg, p_size > 25 AS is_prime_eligible,
         CAST(1980 + p_size % 16 AS INTEGER) AS launch_year
  FROM part
),
dim_customers AS (
  SELECT c.c_custkey AS customer_id, r.r_name AS customer_city, n.n_name AS customer_state,
         c.c_mktsegment AS customer_tier,
         CASE c.c_custkey % 5 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-45'
              WHEN 3 THEN '46-55' WHEN 4 THEN '55+' END AS customer_age_group,
         CASE WHEN c.c_acctbal < 0 THEN 'Low' WHEN c.c_acctbal < 5000 THEN 'Medium' ELSE 'High' END
           AS customer_spending_tier,
         c.c_acctbal > 4000 AS is_prime_member
  FROM customer c
  LEFT JOIN (nation n JOIN region r ON n.n_regionkey = r.r_regionkey) ON c.c_nationkey = n.n_nationkey
)"""

# The §2.11 queries filter the sentinel day; model queries read everything (quirk Q4).
STAR_CTE = (
    "WITH" + _FACT_ALL + ",\nfact_transactions AS (SELECT * FROM fact_all WHERE order_date > DATE '1900-01-01'),"
    + _DIMS + "\n"
)


def star(sql: str) -> str:
    """Prefix a query over the star views with their definitions.

    ``sql`` may start with further CTEs using a leading comma-free ``WITH``;
    that keyword is merged into the star's ``WITH`` list.
    """
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return STAR_CTE + "," + body[5:]
    return STAR_CTE + body
