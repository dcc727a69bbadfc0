"""Star schema (fact_transactions + dims) over the driver's TPC-H-like tables.

The mapping is the one in FIXTURES.md part C.  Money is kept exact: extended
price, discount and tax are cast to DECIMAL, so every SUM is independent of
row order and partitioning.  Keys stay BIGINT (cheaper to hash and shuffle than
strings).

Scale notes
-----------
* ``fact_transactions`` is ``lineitem JOIN orders`` on the order key: the one
  big-big join of the model.  It is a sort-merge join on ``l_orderkey``; every
  query that groups by transaction or customer re-uses that partitioning.
* ``dim_customers`` joins ``customer`` to ``nation`` and ``region``; those two
  are fixed-size reference tables (25 and 5 rows at every scale factor), so
  they are broadcast explicitly.  ``customer`` and ``part`` grow with the scale
  factor and are never force-broadcast: AQE converts to a broadcast join at
  runtime only when the measured size is below the threshold.
* The sentinel filter ``order_date > DATE '1900-01-01'`` is expressed on the
  raw ``o_orderdate`` column, so it reaches the parquet scan as a pushed filter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

SENTINEL_DATE = "1900-01-01"

# Fixed values of the synthetic mapping (FIXTURES.md part C).
PAYMENT_BY_PRIORITY = {"1": "UPI", "2": "Credit Card", "3": "COD", "4": "Net Banking", "5": "BNPL"}
FESTIVAL_BY_MONTH = {10: "Navratri", 11: "Diwali", 1: "Republic Day"}
AGE_GROUPS = ["18-25", "26-35", "36-45", "46-55", "55+"]


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    products: DataFrame
    customers: DataFrame


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the line items that ``fact_columns`` reads."""
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )


def fact_lines(li: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items joined with their orders, before any column is derived."""
    return li.join(orders, li.l_orderkey == orders.o_orderkey)


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")


def fact_transactions(spark: SparkSession, sf_dir: str, exclude_sentinel: bool = True) -> DataFrame:
    """One row per line item, enriched with its order (FIXTURES.md C)."""
    orders = fact_orders(spark, sf_dir)
    if exclude_sentinel:
        # strictly after the sentinel day == on or after the next day; on the raw column so it is pushed down
        orders = orders.filter(F.col("o_orderdate") >= F.lit("1900-01-02").cast("timestamp"))
    return fact_lines(line_rows(spark, sf_dir), orders).select(*fact_columns())


def fact_columns() -> list[Column]:
    """The fact's columns over ``fact_lines``."""
    order_date = F.to_date("o_orderdate")
    month = F.month(order_date)
    disc = F.col("l_discount").cast("decimal(3,2)")
    tax = F.col("l_tax").cast("decimal(3,2)")
    mrp = _money("l_extendedprice")
    subtotal = mrp * (F.lit(1) - disc)
    delivery = F.pmod(F.datediff(F.to_date("l_shipdate"), order_date), F.lit(16))
    payment = F.lit(None).cast("string")
    for k, v in PAYMENT_BY_PRIORITY.items():
        payment = F.when(F.substring("o_orderpriority", 1, 1) == k, F.lit(v)).otherwise(payment)
    festival = F.lit(None).cast("string")
    for m, name in FESTIVAL_BY_MONTH.items():
        festival = F.when(month == m, F.lit(name)).otherwise(festival)

    return [
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        order_date.alias("order_date"),
        F.year(order_date).alias("order_year"),
        month.alias("order_month"),
        F.quarter(order_date).alias("order_quarter"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("original_price_inr"),
        (disc * 100).alias("discount_percent"),
        (F.col("l_extendedprice") / F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).alias("discounted_price_inr"),
        F.col("l_quantity").cast("int").alias("quantity"),
        mrp.alias("mrp_inr"),
        subtotal.alias("subtotal_inr"),
        (subtotal * (F.lit(1) + tax)).alias("final_amount_inr"),
        payment.alias("payment_method"),
        delivery.cast("double").alias("delivery_days"),
        F.when(delivery == 0, "Same Day").when(delivery <= 2, "Express").otherwise("Standard").alias("delivery_type"),
        F.when(F.col("l_returnflag") == "R", "Returned").otherwise("Not Returned").alias("return_status"),
        F.when(F.col("l_linenumber") == 3, F.lit(None))
        .otherwise((F.lit(1) + F.pmod("l_orderkey", F.lit(9)) / F.lit(2)).cast("decimal(2,1)"))
        .alias("customer_rating"),
        month.isin(*FESTIVAL_BY_MONTH).alias("is_festival_sale"),
        festival.alias("festival_name"),
        F.when(month.isin(*FESTIVAL_BY_MONTH), "festival").otherwise("normal").alias("sale_type"),
        (F.lit(1) + F.pmod("l_partkey", F.lit(41)) / F.lit(10)).cast("decimal(2,1)").alias("product_rating"),
    ]


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lit("Electronics").alias("category"),
        F.col("p_type").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("base_price_2015"),
        (F.col("p_size") / F.lit(10.0)).alias("weight_kg"),
        (F.col("p_size") > 25).alias("is_prime_eligible"),
        (F.lit(1980) + F.pmod("p_size", F.lit(16))).cast("int").alias("launch_year"),
    )


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table's part of ``dim_customers``: narrow rows, without the names of places."""
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, "Low").when(F.col("c_acctbal") < 5000, "Medium").otherwise("High")
        .alias("customer_spending_tier"),
        (F.col("c_acctbal") > 4000).alias("is_prime_member"),
    )


def with_places(customers: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have ``c_nationkey``, with the names of nation and region."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation / region are fixed 25 / 5 row reference tables: a proven size bound.
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return customers.join(F.broadcast(geo), customers.c_nationkey == geo.n_nationkey, "left")


def customer_columns() -> list[Column]:
    """The columns of ``dim_customers`` over rows with places."""
    age = F.lit(None).cast("string")
    for i, g in enumerate(AGE_GROUPS):
        age = F.when(F.pmod("c_custkey", F.lit(5)) == i, F.lit(g)).otherwise(age)
    return [
        F.col("c_custkey").alias("customer_id"),
        F.col("r_name").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
        F.col("c_mktsegment").alias("customer_tier"),
        age.alias("customer_age_group"),
        F.col("customer_spending_tier"),
        F.col("is_prime_member"),
    ]


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_places(customer_rows(spark, sf_dir), spark, sf_dir).select(*customer_columns())


def load_star(spark: SparkSession, sf_dir: str, exclude_sentinel: bool = True) -> Star:
    return Star(
        fact=fact_transactions(spark, sf_dir, exclude_sentinel),
        products=dim_products(spark, sf_dir),
        customers=dim_customers(spark, sf_dir),
    )


def in_years(fact: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Rows of whole years, as a range of dates: unlike a test of ``order_year``, it reaches the parquet scan."""
    return fact.where((F.col("order_date") >= F.lit(f"{first_year}-01-01").cast("date"))
                      & (F.col("order_date") < F.lit(f"{last_year + 1}-01-01").cast("date")))


def dim_time(fact: DataFrame) -> DataFrame:
    """K4: one row per distinct order date after 1900 (Mon=0 weekday, weekend >= 5)."""
    d = fact.select("order_date").where(F.year("order_date") > 1900).distinct()
    return d.select(
        F.col("order_date").alias("date_id"),
        F.dayofmonth("order_date").alias("day"),
        F.month("order_date").alias("month"),
        F.quarter("order_date").alias("quarter"),
        F.year("order_date").alias("year"),
        (F.weekday("order_date") >= 5).alias("is_weekend"),
        F.lit(False).alias("is_festival"),
        F.lit(None).cast("string").alias("festival_name"),
    )
