"""Named dashboard queries, as DataFrame functions.

Inputs are the star views (``fact`` = fact_transactions without sentinel rows,
``products`` = dim_products, ``customers`` = dim_customers).  Year parameters
default to the test tables' calendar (1995-2001) instead of the reference's
2015-2025; the semantics are unchanged.

Plan shape at scale
-------------------
Additive measures (sum, count, min, max) are first aggregated on the fact side
by the join key (``product_id`` / ``customer_id``): the partial aggregate runs
map-side, so the join with a dimension then moves one row per key instead of
one row per line item.  Measures that are not additive across keys (distinct
customers per subcategory) join first and let AQE choose broadcast or
sort-merge from the measured dimension size.  Top-k reports end in
``orderBy(...).limit(k)`` which Spark plans as a per-partition top-k
(TakeOrderedAndProject), not a full sort; every order has a key tiebreak so the
cut is deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.aggs import count_if, dmean, dsum
from ..session import cut
from ..sources.star import in_years

def _returned():
    return F.col("return_status") == "Returned"


def _sub_totals(fact: DataFrame, products: DataFrame, *extra_keys: str) -> DataFrame:
    """Revenue / line count per (subcategory, *extra_keys), pre-aggregated by product."""
    by_prod = fact.groupBy("product_id", *extra_keys).agg(
        F.sum("final_amount_inr").alias("_rev"), F.count(F.lit(1)).alias("_n")
    )
    j = by_prod.join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    return j.groupBy("subcategory", *extra_keys).agg(F.sum("_rev").alias("_rev"), F.sum("_n").alias("_n"))


# --------------------------------------------------------------------------- overview

def kpis(fact: DataFrame) -> DataFrame:
    """Q-KPI: total revenue, rows, distinct customers, average order value."""
    return fact.agg(
        dsum("final_amount_inr").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        dmean("final_amount_inr").alias("avg_order_value"),
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Q-MREV."""
    return (
        fact.groupBy("order_year", "order_month")
        .agg(dsum("final_amount_inr").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy("order_year", "order_month")
    )


def top_subcategories(fact: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Q-TOPSUB: top-k subcategories by revenue."""
    t = _sub_totals(fact, products)
    return (
        t.select("subcategory", F.col("_rev").cast("double").alias("revenue"), F.col("_n").alias("orders"))
        .orderBy(F.desc("revenue"), "subcategory")
        .limit(limit)
    )


def top_states(fact: DataFrame, customers: DataFrame, limit: int = 10) -> DataFrame:
    """Q-TOPSTATE: top-k customer states by revenue (pre-aggregated per customer)."""
    by_cust = fact.groupBy("customer_id").agg(F.sum("final_amount_inr").alias("_rev"), F.count(F.lit(1)).alias("_n"))
    j = by_cust.join(customers.select("customer_id", "customer_state").where(F.col("customer_state").isNotNull()),
                     "customer_id")
    return (
        j.groupBy("customer_state")
        .agg(dsum("_rev").alias("revenue"), F.sum("_n").alias("orders"))
        .orderBy(F.desc("revenue"), "customer_state")
        .limit(limit)
    )


def payment_methods(fact: DataFrame) -> DataFrame:
    """Q-PAY."""
    return (
        fact.where(F.col("payment_method").isNotNull())
        .groupBy("payment_method")
        .agg(F.count(F.lit(1)).alias("orders"), dsum("final_amount_inr").alias("revenue"))
        .orderBy(F.desc("orders"), "payment_method")
    )


# --------------------------------------------------------------------------- customers

def customer_tier_distribution(customers: DataFrame) -> DataFrame:
    """Q-TIERDIST: customers per tier (dimension only)."""
    return (
        customers.where(F.col("customer_tier").isNotNull())
        .groupBy("customer_tier").agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "customer_tier")
    )


def recency_distribution(fact: DataFrame) -> DataFrame:
    """Q-RECENCY: per customer last order date, rows, spend."""
    return fact.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("order_count"),
        dsum("final_amount_inr").alias("total_spend"),
    )


def monthly_active_customers(fact: DataFrame) -> DataFrame:
    """Q-MAC."""
    return (
        fact.groupBy("order_year", "order_month")
        .agg(F.countDistinct("customer_id").alias("active_customers"))
        .orderBy("order_year", "order_month")
    )


# --------------------------------------------------------------------------- forecast page

def subcategory_list(products: DataFrame) -> DataFrame:
    """Q-SUBLIST."""
    return products.where(F.col("subcategory").isNotNull()).select("subcategory").distinct().orderBy("subcategory")


def subcategory_monthly(fact: DataFrame, products: DataFrame, subcategory: str) -> DataFrame:
    """Q-SUBMONTH: monthly series of one subcategory (semi-join on the matching products)."""
    prods = products.where(F.col("subcategory") == subcategory).select("product_id")
    return (
        fact.join(prods, "product_id", "left_semi")
        .groupBy("order_year", "order_month")
        .agg(dsum("final_amount_inr").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy("order_year", "order_month")
    )


def top10_heatmap(fact: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Q-HEAT: top-k subcategories by revenue x calendar month, revenue in millions."""
    t = _sub_totals(fact, products, "order_month")
    top = (
        t.groupBy("subcategory").agg(F.sum("_rev").alias("r"))
        .orderBy(F.desc("r"), "subcategory").limit(k).select("subcategory")
    )
    return (
        t.join(top, "subcategory", "left_semi")
        .select("subcategory", "order_month", (F.col("_rev").cast("double") / 1e6).alias("revenue_m"))
        .orderBy("subcategory", "order_month")
    )


def yoy_growth(fact: DataFrame, products: DataFrame, year_a: int = 1999, year_b: int = 2000,
               limit: int = 15) -> DataFrame:
    """Q-YOY: growth % from year_a to year_b, both years positive, top-k."""
    in_both = in_years(fact, min(year_a, year_b), max(year_a, year_b)).where(F.col("order_year").isin(year_a, year_b))
    t = _sub_totals(in_both, products, "order_year")
    by = t.groupBy("subcategory").agg(
        F.sum(F.when(F.col("order_year") == year_a, F.col("_rev")).otherwise(0)).cast("double").alias("rev_a"),
        F.sum(F.when(F.col("order_year") == year_b, F.col("_rev")).otherwise(0)).cast("double").alias("rev_b"),
    )
    return (
        by.where((F.col("rev_a") > 0) & (F.col("rev_b") > 0))
        .select("subcategory", "rev_a", "rev_b",
                ((F.col("rev_b") - F.col("rev_a")) / F.col("rev_a") * 100).alias("growth_pct"))
        .orderBy(F.desc("growth_pct"), "subcategory")
        .limit(limit)
    )


# --------------------------------------------------------------------------- samples

def _sample_key() -> F.Column:
    """Deterministic pseudo-random order: md5 of the line key (same value in any SQL engine)."""
    return F.md5(F.concat_ws("-", "transaction_id", "product_id", "supplier_id", "line_number"))


def price_distribution(fact: DataFrame, products: DataFrame, subcategory: str, n: int = 2000) -> DataFrame:
    """Q-PRICEDIST: an n-row sample of prices of one subcategory.

    ``ORDER BY RANDOM() LIMIT n`` made reproducible: order by a hash of the line
    key.  Spark runs it as a per-partition top-n, so no full sort happens.
    """
    prods = products.where(F.col("subcategory") == subcategory).select("product_id")
    f = fact.join(prods, "product_id", "left_semi").where(F.col("original_price_inr").isNotNull())
    return (
        f.orderBy(_sample_key(), "final_amount_inr")
        .limit(n)
        .select("original_price_inr", F.col("discount_percent").cast("double").alias("discount_percent"),
                F.col("final_amount_inr").cast("double").alias("final_amount_inr"))
    )


def transaction_sample(fact: DataFrame, n: int = 3000) -> DataFrame:
    """Q-TXSAMPLE: n-row deterministic sample for the anomaly page."""
    f = fact.where(F.col("discount_percent").isNotNull() & F.col("delivery_days").isNotNull())
    return (
        f.orderBy(_sample_key(), "final_amount_inr")
        .limit(n)
        .select(F.col("discount_percent").cast("double").alias("discount_percent"),
                F.col("final_amount_inr").cast("double").alias("final_amount_inr"),
                "delivery_days", "return_status")
    )


# --------------------------------------------------------------------------- recommendations page

def popular_subcategories(fact: DataFrame, products: DataFrame, limit: int = 15) -> DataFrame:
    """Q-POP: distinct baskets and customers per subcategory.

    Lines are first reduced to (subcategory, customer, basket), then to (subcategory, customer): a basket has one
    customer, so baskets and customers are counted as rows and no line is expanded for a distinct count.
    """
    kinds = products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull())
    # the products of a partition are few, so lines need no sort to meet them, whose memory the groups could not use
    j = fact.select("product_id", "transaction_id", "customer_id", "final_amount_inr").join(kinds.hint("shuffle_hash"), "product_id")
    baskets = j.groupBy("subcategory", "customer_id", "transaction_id").agg(F.sum("final_amount_inr").alias("_rev"))
    buyers = baskets.groupBy("subcategory", "customer_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("_rev").alias("_rev"))
    return (
        buyers.groupBy("subcategory").agg(
            F.sum("_n").alias("order_count"),
            F.count("customer_id").alias("customer_count"),
            (dsum("_rev") / 1e6).alias("revenue_m"),
        )
        .orderBy(F.desc("order_count"), "subcategory")
        .limit(limit)
    )


def _pairs_below(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of (basket, item, idx) sorted by basket and item: (part, basket, a, b, n) with the pairs of a smaller item of a and
    a larger one of b (no basket), and the lines of each a in the partition's first and last basket (no b), which may go
    on in other partitions.  A batch is counted at once; what is kept between batches has k numbers.
    """
    pairs, edges, first = np.zeros((k, k), np.int64), {}, None
    basket, item = None, None  # the last line seen
    held, same = np.zeros(k, np.int64), np.zeros(k, np.int64)  # its basket's lines so far, those of its item among them
    for batch in batches:
        if not batch.num_rows:
            continue
        of, what, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        n = len(of)
        first = of[0] if first is None else first
        seen = np.zeros((n + 1, k), np.int64)
        seen[1:] = np.cumsum(kind[:, None] == np.arange(k), axis=0)
        new_basket = np.concatenate([[basket is None or of[0] != basket], of[1:] != of[:-1]])
        new_item = new_basket | np.concatenate([[item is None or what[0] != item], what[1:] != what[:-1]])
        start = lambda new: np.maximum.accumulate(np.where(new, np.arange(n), 0))
        below = seen[start(new_item)] - seen[start(new_basket)]
        below[np.cumsum(new_basket) == 0] += held
        below[np.cumsum(new_item) == 0] -= same
        for b in range(k):
            pairs[:, b] += below[kind == b].sum(axis=0)
        for name in {first, of[-1]}:
            edges[name] = edges.get(name, 0) + np.bincount(kind[of == name], minlength=k)
        held = seen[n] - seen[start(new_basket)[-1]] + (0 if new_basket.any() else held)
        same = seen[n] - seen[start(new_item)[-1]] + (0 if new_item.any() else same)
        basket, item = of[-1], what[-1]
        edges = {name: lines for name, lines in edges.items() if name in (first, basket)}
    part = TaskContext.get().partitionId()
    rows = [(part, None, a, b, int(pairs[a, b])) for a in range(k) for b in range(k) if pairs[a, b]]
    rows += [(part, int(name), a, None, int(lines[a])) for name, lines in edges.items() for a in range(k) if lines[a]]
    yield pa.RecordBatch.from_pylist([dict(zip(PAIRS.names, r, strict=True)) for r in rows], PAIRS)


PAIRS = pa.schema([("part", pa.int32()), ("basket", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])


def copurchase_matrix(fact: DataFrame, products: DataFrame, k: int = 8) -> DataFrame:
    """Q-COPURCH: pair counts of top-k subcategories bought in the same basket.

    Semantics: for lines x, y of one basket with ``product_id(x) < product_id(y)``
    and both subcategories in the top-k by line count, count (sub(x), sub(y));
    the result is that table plus its mirror (UNION ALL).

    No pairs are materialised.  Narrow lines (basket, product, place in the top-k) are sorted in ranges of basket and
    product, so a huge basket is split over partitions, and each partition is counted in one streaming pass that keeps
    k x k numbers.  Pairs of a basket whose lines lie in several partitions come from the number of lines of its first
    and last basket that each partition adds.  Work is linear in the number of lines times k.
    """
    top = (
        fact.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
        .join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
        .groupBy("subcategory").agg(F.sum("_n").alias("_n"))
        .orderBy(F.desc("_n"), "subcategory").limit(k)
    )
    # the k names with their place are stored, as lines and names read them
    top = cut(top.select("subcategory", (F.row_number().over(Window.orderBy(F.desc("_n"), "subcategory")) - 1).alias("idx")))
    wanted = products.select("product_id", "subcategory").join(F.broadcast(top), "subcategory").select("product_id", "idx")
    lines = fact.select("transaction_id", "product_id").join(wanted, "product_id").where(F.col("transaction_id").isNotNull())
    ranged = lines.repartitionByRange("transaction_id", "product_id").sortWithinPartitions("transaction_id", "product_id")
    parts = cut(ranged.select(F.col("transaction_id").cast("bigint"), F.col("product_id").cast("bigint"), F.col("idx").cast("int")).mapInArrow(
        lambda batches: _pairs_below(batches, k), "part int, basket bigint, a int, b int, n bigint"))
    edges = parts.where("b IS NULL")
    later = edges.select(F.col("basket").alias("_basket"), F.col("part").alias("_part"), F.col("a").alias("_b"), F.col("n").alias("_n"))
    across = edges.join(later, (F.col("basket") == F.col("_basket")) & (F.col("part") < F.col("_part"))).select(
        "a", F.col("_b").alias("b"), (F.col("n") * F.col("_n")).alias("n"))
    counts = parts.where("b IS NOT NULL").select("a", "b", "n").unionByName(across).groupBy("a", "b").agg(F.sum("n").alias("co_count"))
    names = lambda col, name: F.broadcast(top.select(F.col("idx").alias(col), F.col("subcategory").alias(name)))
    pairs = counts.where(F.col("co_count") > 0).join(names("a", "cat_a"), "a").join(names("b", "cat_b"), "b")
    both = F.explode(F.array(F.struct("cat_a", "cat_b"), F.struct(F.col("cat_b").alias("cat_a"), F.col("cat_a").alias("cat_b"))))
    return pairs.select(both.alias("p"), "co_count").select("p.*", "co_count").orderBy("cat_a", "cat_b")


# --------------------------------------------------------------------------- festival & seasonal

def festival_comparison(fact: DataFrame) -> DataFrame:
    """Q-FEST."""
    f = fact.where((F.col("is_festival_sale") == F.lit(True)) & F.col("festival_name").isNotNull())
    return (
        f.groupBy("festival_name").agg(
            F.count(F.lit(1)).alias("orders"),
            (dsum("final_amount_inr") / 1e6).alias("revenue_m"),
            dmean("final_amount_inr").alias("avg_order_value"),
            dmean("discount_percent").alias("avg_discount"),
        )
        .orderBy(F.desc("revenue_m"), "festival_name")
    )


def festival_vs_regular(fact: DataFrame, first_year: int = 1995, last_year: int = 2001) -> DataFrame:
    """Q-FESTREG: festival vs regular revenue per year (null flag counts on neither side)."""
    fest = F.col("is_festival_sale")
    return (
        in_years(fact, first_year, last_year)
        .groupBy("order_year").agg(
            (F.sum(F.when(fest, F.col("final_amount_inr")).otherwise(0)).cast("double") / 1e6).alias("festival_rev_m"),
            (F.sum(F.when(~fest, F.col("final_amount_inr")).otherwise(0)).cast("double") / 1e6).alias("regular_rev_m"),
        )
        .orderBy("order_year")
    )


def monthly_avg_revenue(fact: DataFrame) -> DataFrame:
    """Q-SEASON: mean over years of the monthly revenue (millions), per calendar month."""
    monthly = fact.groupBy("order_year", "order_month").agg(F.sum("final_amount_inr").alias("_rev"))
    return (
        monthly.groupBy("order_month")
        .agg((F.sum("_rev").cast("double") / 1e6 / F.count("_rev")).alias("avg_rev_m"))
        .orderBy("order_month")
    )


def festival_subcategory(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q-FESTSUB."""
    f = fact.where((F.col("is_festival_sale") == F.lit(True)) & F.col("festival_name").isNotNull())
    t = _sub_totals(f, products, "festival_name")
    return (
        t.select("subcategory", "festival_name", (F.col("_rev").cast("double") / 1e6).alias("revenue_m"))
        .orderBy(F.desc("revenue_m"), "subcategory", "festival_name")
    )


# --------------------------------------------------------------------------- prime & demographics

def _by_customer(fact: DataFrame) -> DataFrame:
    """Per-customer partial sums: rows, revenue, discount sum and count."""
    return fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("final_amount_inr").alias("_rev"),
        F.sum("discount_percent").alias("_disc"),
        F.count("discount_percent").alias("_ndisc"),
        F.count("final_amount_inr").alias("_nrev"),
    )


def _cust_kpis(fact: DataFrame, customers: DataFrame, key: str, cond=None) -> DataFrame:
    c = customers.select("customer_id", key)
    if cond is not None:
        c = c.where(cond)
    j = _by_customer(fact).join(c, "customer_id")
    return j.groupBy(key).agg(
        F.count(F.lit(1)).alias("customers"),  # one row per customer after pre-aggregation
        F.sum("_n").alias("orders"),
        (F.sum("_rev").cast("double") / 1e6).alias("revenue_m"),
        (F.sum("_rev").cast("double") / F.sum("_nrev")).alias("avg_order_value"),
        (F.sum("_disc").cast("double") / F.sum("_ndisc")).alias("avg_discount"),
    )


def prime_detailed(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Q-PRIME: KPIs by prime flag; a null flag is its own group."""
    return _cust_kpis(fact, customers, "is_prime_member")


def prime_category_preference(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Q-PRIMECAT: prime flag x subcategory revenue (millions)."""
    j = (
        fact.select("customer_id", "product_id", "final_amount_inr")
        .join(customers.select("customer_id", "is_prime_member"), "customer_id")
        .groupBy("is_prime_member", "product_id").agg(F.sum("final_amount_inr").alias("_rev"))
        .join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    )
    return (
        j.groupBy("is_prime_member", "subcategory").agg((dsum("_rev") / 1e6).alias("revenue_m"))
        .orderBy(F.desc("revenue_m"), "subcategory", "is_prime_member")
    )


def age_group_spending(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Q-AGE."""
    cond = F.col("customer_age_group").isNotNull() & (F.col("customer_age_group") != "nan")
    return (
        _cust_kpis(fact, customers, "customer_age_group", cond)
        .select("customer_age_group", "customers", "orders", "revenue_m", "avg_order_value")
        .orderBy(F.desc("avg_order_value"), "customer_age_group")
    )


def age_subcategory(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Q-AGESUB."""
    cond = F.col("customer_age_group").isNotNull() & (F.col("customer_age_group") != "nan")
    j = (
        fact.select("customer_id", "product_id", "final_amount_inr")
        .join(customers.select("customer_id", "customer_age_group").where(cond), "customer_id")
        .groupBy("customer_age_group", "product_id").agg(F.sum("final_amount_inr").alias("_rev"))
        .join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    )
    return j.groupBy("customer_age_group", "subcategory").agg((dsum("_rev") / 1e6).alias("revenue_m"))


def tier_spending(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Q-TIER."""
    return (
        _cust_kpis(fact, customers, "customer_tier", F.col("customer_tier").isNotNull())
        .select("customer_tier", "customers", "avg_order_value", "revenue_m", "avg_discount")
        .orderBy(F.desc("avg_order_value"), "customer_tier")
    )


# --------------------------------------------------------------------------- brand & products

def brand_detailed(fact: DataFrame, products: DataFrame, limit: int = 15) -> DataFrame:
    """Q-BRAND: brand KPIs, top-k by revenue (pre-aggregated per product)."""
    by_prod = fact.groupBy("product_id").agg(
        F.sum("final_amount_inr").alias("_rev"), F.count(F.lit(1)).alias("_n"),
        F.sum("product_rating").alias("_rs"), F.count("product_rating").alias("_rn"),
        F.sum("discount_percent").alias("_ds"), F.count("discount_percent").alias("_dn"),
    )
    j = by_prod.join(products.select("product_id", "brand").where(F.col("brand").isNotNull()), "product_id")
    return (
        j.groupBy("brand").agg(
            (F.sum("_rev").cast("double") / 1e9).alias("revenue_bn"),
            F.sum("_n").alias("orders"),
            (F.sum("_rs").cast("double") / F.sum("_rn")).alias("avg_rating"),
            (F.sum("_ds").cast("double") / F.sum("_dn")).alias("avg_discount"),
            F.count(F.lit(1)).alias("products"),
        )
        .orderBy(F.desc("revenue_bn"), "brand")
        .limit(limit)
    )


def _sub_quality(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Per-subcategory partial sums for the rating / returns scorecards."""
    by_prod = fact.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("final_amount_inr").alias("_rev"),
        F.sum(F.when(_returned(), 1).otherwise(0)).alias("_ret"),
        F.sum("product_rating").alias("_rs"), F.count("product_rating").alias("_rn"),
        F.sum(F.when(F.col("product_rating") >= 4, 1).otherwise(0)).alias("_hi"),
        F.sum(F.when(F.col("product_rating") < 3, 1).otherwise(0)).alias("_lo"),
        F.sum("discount_percent").alias("_ds"), F.count("discount_percent").alias("_dn"),
    )
    j = by_prod.join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    return j.groupBy("subcategory").agg(*[F.sum(c).alias(c) for c in
                                          ("_n", "_rev", "_ret", "_rs", "_rn", "_hi", "_lo", "_ds", "_dn")])


def product_ratings_detail(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q-RATING: rows with a rating only."""
    s = _sub_quality(fact.where(F.col("product_rating").isNotNull()), products)
    return (
        s.select(
            "subcategory",
            F.round(F.col("_rs").cast("double") / F.col("_rn"), 2).alias("avg_rating"),
            F.col("_n").alias("reviews"),
            (F.col("_hi").cast("double") / F.col("_n") * 100).alias("pct_high"),
            (F.col("_lo").cast("double") / F.col("_n") * 100).alias("pct_low"),
        )
        .orderBy(F.desc("avg_rating"), "subcategory")
    )


def launch_year_revenue(fact: DataFrame, products: DataFrame, first_year: int = 1985,
                        last_year: int = 1995) -> DataFrame:
    """Q-LAUNCH: launch year x subcategory revenue and product count."""
    by_prod = fact.groupBy("product_id").agg(F.sum("final_amount_inr").alias("_rev"))
    p = products.select("product_id", "launch_year", "subcategory").where(
        F.col("launch_year").isNotNull() & F.col("launch_year").between(first_year, last_year))
    return (
        by_prod.join(p, "product_id")
        .groupBy("launch_year", "subcategory")
        .agg((dsum("_rev") / 1e6).alias("revenue_m"), F.count(F.lit(1)).alias("products"))
        .orderBy("launch_year", F.desc("revenue_m"), "subcategory")
    )


def returns_detail(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q-RETURNS."""
    s = _sub_quality(fact, products)
    return (
        s.select(
            "subcategory",
            F.col("_n").alias("total_orders"),
            F.col("_ret").cast("bigint").alias("returns"),
            F.round(F.col("_ret").cast("double") / F.col("_n") * 100, 2).alias("return_rate"),
            (F.col("_rs").cast("double") / F.col("_rn")).alias("avg_rating"),
            (F.col("_ds").cast("double") / F.col("_dn")).alias("avg_discount"),
        )
        .orderBy(F.desc("return_rate"), "subcategory")
    )


# --------------------------------------------------------------------------- customer journey

def purchase_frequency(fact: DataFrame) -> DataFrame:
    """Q-FREQ: histogram of rows per customer."""
    per = fact.groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"))
    return per.groupBy("order_count").agg(F.count(F.lit(1)).alias("customers")).orderBy("order_count")


def category_transitions(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q-TRANS: from -> to subcategory of consecutive purchases of a customer.

    The reference self-joins ROW_NUMBER() on rn + 1; ``lead()`` over the same
    order is equivalent and needs no join.  The order is made total with the line
    key (the reference orders by date only, quirk Q15).
    """
    j = fact.select("customer_id", "product_id", "order_date", "transaction_id", "line_number", "supplier_id").join(
        products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    w = Window.partitionBy("customer_id").orderBy("order_date", "transaction_id", "line_number", "product_id",
                                                  "supplier_id")
    t = j.select(F.col("subcategory").alias("from_cat"), F.lead("subcategory").over(w).alias("to_cat"))
    return (
        t.where(F.col("to_cat").isNotNull())
        .groupBy("from_cat", "to_cat").agg(F.count(F.lit(1)).alias("transitions"))
        .orderBy(F.desc("transitions"), "from_cat", "to_cat")
    )


def product_performance_summary(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q-SCORE: subcategory scorecard (distinct customers => join before grouping)."""
    j = fact.select("product_id", "customer_id", "final_amount_inr", "product_rating", "return_status").join(
        products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    return (
        j.groupBy("subcategory").agg(
            (dsum("final_amount_inr") / 1e6).alias("revenue_m"),
            F.count(F.lit(1)).alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
            dmean("product_rating").alias("avg_rating"),
            F.round(count_if(_returned()).cast("double") / F.count(F.lit(1)) * 100, 1).alias("return_rate"),
        )
        .orderBy(F.desc("revenue_m"), "subcategory")
    )


def clv_by_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Q-CLV: mean customer value and rows per tier."""
    cs = fact.groupBy("customer_id").agg(F.sum("final_amount_inr").alias("clv"), F.count(F.lit(1)).alias("orders"))
    j = cs.join(customers.select("customer_id", "customer_tier").where(F.col("customer_tier").isNotNull()),
                "customer_id")
    return (
        j.groupBy("customer_tier").agg(
            F.round(F.sum("clv").cast("double") / F.count("clv"), 0).alias("avg_clv"),
            F.round(F.sum("orders").cast("double") / F.count("orders"), 1).alias("avg_orders"),
            F.count(F.lit(1)).alias("customers"),
        )
        .orderBy(F.desc("avg_clv"), "customer_tier")
    )


def anomaly_summary(fact: DataFrame) -> DataFrame:
    """Q-ANOMSUM: means, exact P95s, share not 'Not Returned'."""
    return fact.agg(
        F.round(dmean("discount_percent"), 2).alias("avg_discount_pct"),
        F.round(F.percentile(F.col("discount_percent").cast("double"), F.lit(0.95)), 2).alias("p95_discount_pct"),
        F.round(dmean("delivery_days"), 2).alias("avg_delivery_days"),
        F.round(F.percentile("delivery_days", F.lit(0.95)), 2).alias("p95_delivery_days"),
        F.round(count_if(F.col("return_status") != "Not Returned").cast("double") / F.count(F.lit(1)) * 100, 2)
        .alias("return_rate_pct"),
        F.count(F.lit(1)).alias("total_transactions"),
    )


# --------------------------------------------------------------------------- executive dashboard

def current_month_perf(fact: DataFrame) -> DataFrame:
    """Q-CURMONTH: latest year-month vs the same month a year earlier.

    One pass builds a row per month; the latest is the first by year and month, and the same month of the year before
    lies exactly 100 below it in yyyymm, so a range window over the months finds it.  No join.
    """
    monthly = fact.groupBy("order_year", "order_month").agg(
        F.sum("final_amount_inr").alias("_rev"), F.count(F.lit(1)).alias("orders"),
        F.countDistinct("customer_id").alias("customers"), dmean("final_amount_inr").alias("aov"))
    ym = F.col("order_year") * 100 + F.col("order_month")
    ago = Window.orderBy("ym").rangeBetween(-100, -100)  # over one row per month
    m = monthly.withColumn("ym", ym).select(
        "*", F.max("_rev").over(ago).alias("_prev"), F.max("orders").over(ago).alias("_n_prev"))
    return m.orderBy(F.desc("ym")).limit(1).select(
        "order_year", "order_month", (F.col("_rev").cast("double") / 1e6).alias("rev_m"), "orders", "customers", "aov",
        (F.col("_prev").cast("double") / 1e6).alias("rev_m_prev"), F.coalesce("_n_prev", F.lit(0)).cast("bigint").alias("orders_prev"))


def yearly_revenue(fact: DataFrame, first_year: int = 1995, last_year: int = 2001) -> DataFrame:
    """Q-YEARLY: yearly KPIs plus revenue-weighted mean discount."""
    return (
        in_years(fact, first_year, last_year)
        .groupBy("order_year").agg(
            (dsum("final_amount_inr") / 1e9).alias("rev_bn"),
            F.count(F.lit(1)).alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
            dmean("final_amount_inr").alias("aov"),
            (F.sum(F.col("discount_percent") * F.col("final_amount_inr")).cast("double")
             / F.nullif(dsum("final_amount_inr"), F.lit(0.0))).alias("avg_discount_weighted"),
        )
        .orderBy("order_year")
    )


def category_market_share(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q-SHARE."""
    t = _sub_totals(fact, products)
    return (
        t.select(F.col("subcategory").alias("category"), (F.col("_rev").cast("double") / 1e9).alias("rev_bn"),
                 F.col("_n").alias("orders"))
        .orderBy(F.desc("rev_bn"), "category")
    )


def geographic_spread(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Q-GEO: state x tier revenue and customers (pre-aggregated per customer)."""
    by_cust = fact.groupBy("customer_id").agg(F.sum("final_amount_inr").alias("_rev"))
    j = by_cust.join(customers.select("customer_id", "customer_state", "customer_tier")
                     .where(F.col("customer_state").isNotNull()), "customer_id")
    return (
        j.groupBy("customer_state", "customer_tier")
        .agg((dsum("_rev") / 1e6).alias("rev_m"), F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("rev_m"), "customer_state", "customer_tier")
    )


def new_customer_growth(fact: DataFrame, first_year: int = 1995, last_year: int = 2001) -> DataFrame:
    """Q-NEWCUST: customers by first purchase year."""
    first = fact.groupBy("customer_id").agg(F.min("order_year").alias("cohort_year"))
    return (
        first.where(F.col("cohort_year").between(first_year, last_year))
        .groupBy("cohort_year").agg(F.count(F.lit(1)).alias("new_customers"))
        .orderBy("cohort_year")
    )


def discount_revenue_impact(fact: DataFrame, first_year: int = 1995, last_year: int = 2001) -> DataFrame:
    """Q-DISC: gross (list price x quantity), net, discount given, mean discount per year."""
    # list price x quantity is a double; each line is fixed to 4 decimals before an exact sum
    gross_line = (F.col("original_price_inr") * F.col("quantity")).cast("decimal(18,4)")
    f = in_years(fact, first_year, last_year).where(F.col("original_price_inr").isNotNull())
    return (
        f.groupBy("order_year").agg(
            dsum(gross_line).alias("gross_rev"),
            dsum("final_amount_inr").alias("net_rev"),
            dsum(gross_line - F.col("final_amount_inr")).alias("discount_given"),
            dmean("discount_percent").alias("avg_discount_pct"),
        )
        .orderBy("order_year")
    )


def kpi_alert_data(fact: DataFrame) -> DataFrame:
    """Q-ALERT: one-row snapshot; previous year = latest year - 1 (quirk Q18: return and delivery all-time).

    One pass over the fact builds per-year partial sums; everything else is
    conditional aggregation over that table of one row per year.
    """
    yearly = fact.groupBy("order_year").agg(
        F.sum("final_amount_inr").alias("_rev"), F.count(F.lit(1)).alias("_n"),
        F.count("final_amount_inr").alias("_nrev"),
        F.sum(F.when(_returned(), 1).otherwise(0)).alias("_ret"),
        F.sum(F.when(F.col("delivery_days") >= 0, F.col("delivery_days"))).alias("_del"),
        F.count(F.when(F.col("delivery_days") >= 0, F.col("delivery_days"))).alias("_ndel"),
    ).withColumn("yr", F.max("order_year").over(Window.partitionBy()))
    is_cur = F.col("order_year") == F.col("yr")
    is_prev = F.col("order_year") == F.col("yr") - 1
    snap = yearly.agg(
        (F.sum(F.when(is_cur, F.col("_rev"))).cast("double") / 1e6).alias("rev_m"),
        F.sum(F.when(is_cur, F.col("_n"))).alias("orders"),
        (F.sum(F.when(is_cur, F.col("_rev"))).cast("double") / F.sum(F.when(is_cur, F.col("_nrev")))).alias("aov"),
        (F.sum(F.when(is_prev, F.col("_rev"))).cast("double") / 1e6).alias("rev_m_prev"),
        F.round(F.sum("_ret").cast("double") / F.sum("_n") * 100, 2).alias("return_rate"),
        F.round(F.sum("_del") / F.sum("_ndel"), 1).alias("avg_del"),
    )
    return snap.select(
        "rev_m", "orders", "aov", "rev_m_prev",
        F.round((F.col("rev_m") - F.col("rev_m_prev")) / F.nullif(F.col("rev_m_prev"), F.lit(0.0)) * 100, 1)
        .alias("yoy_growth_pct"),
        "return_rate", "avg_del",
    )
