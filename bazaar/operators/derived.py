"""Analytics computed on top of the named queries.

Each function takes the (small, already aggregated) output of a §2.11 query
and returns a DataFrame.  Whole-table windows here run over one row per year,
month, tier or subcategory, never over fact rows.  Argmax / argmin use
``min_by`` with a (value, key) struct so that ties resolve to the smallest key,
the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut

def _all():
    return Window.partitionBy()  # whole-table window; only used on aggregated tables


def _argmax(key: str, value: str):
    return F.min_by(F.col(key), F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))


def _argmin(key: str, value: str):
    return F.min_by(F.col(key), F.struct(F.col(value).alias("v"), F.col(key).alias("k")))


# D1 ----------------------------------------------------------------------------------

def alert_evaluation(alert: DataFrame, min_yoy: float = 5.0, max_return: float = 15.0,
                     max_delivery: float = 7.0) -> DataFrame:
    """Threshold alerts over the Q-ALERT row (a missing value counts as 0)."""
    yoy = F.coalesce(F.col("yoy_growth_pct"), F.lit(0.0))
    ret = F.coalesce(F.col("return_rate"), F.lit(0.0))
    dl = F.coalesce(F.col("avg_del"), F.lit(0.0))
    out = alert.select(
        yoy.alias("yoy_growth_pct"), ret.alias("return_rate"), dl.alias("avg_del"),
        (yoy < min_yoy).alias("yoy_alert"), (ret > max_return).alias("return_alert"),
        (dl > max_delivery).alias("delivery_alert"),
    )
    return out.withColumn("n_alerts", F.col("yoy_alert").cast("int") + F.col("return_alert").cast("int")
                          + F.col("delivery_alert").cast("int"))


# D2 ----------------------------------------------------------------------------------

def yearly_growth(yearly: DataFrame) -> DataFrame:
    """Year-over-year % change of revenue (pct_change over ordered years)."""
    w = Window.orderBy("order_year")
    return yearly.select("order_year", "rev_bn", "customers",
                         ((F.col("rev_bn") / F.lag("rev_bn").over(w) - 1) * 100).alias("yoy_pct"))


def growth_summary(yearly: DataFrame) -> DataFrame:
    """Revenue and customer CAGR first->last year, peak revenue year, peak customers."""
    s = yearly.agg(
        F.min_by("rev_bn", "order_year").alias("first_rev"), F.max_by("rev_bn", "order_year").alias("last_rev"),
        F.min_by("customers", "order_year").alias("first_cust"),
        F.max_by("customers", "order_year").alias("last_cust"),
        (F.count(F.lit(1)) - 1).alias("n_years"),
        F.min_by("order_year", F.struct((-F.col("rev_bn")).alias("v"), F.col("order_year").alias("k")))
        .alias("peak_revenue_year"),
        F.max("customers").alias("peak_customers"),
    )

    def cagr(first, last):
        v = (F.pow(F.col(last) / F.col(first), F.lit(1.0) / F.col("n_years")) - 1) * 100
        return F.when((F.col("n_years") >= 1) & (F.col(first) > 0), F.round(v, 6)).otherwise(F.lit(0.0))

    return s.select(cagr("first_rev", "last_rev").alias("revenue_cagr_pct"),
                    cagr("first_cust", "last_cust").alias("customer_cagr_pct"),
                    "peak_revenue_year", "peak_customers")


# D3 ----------------------------------------------------------------------------------

def top_states_from_geo(geo: DataFrame, k: int = 15) -> DataFrame:
    """D3: top-k states by revenue from the state x tier spread."""
    return (geo.groupBy("customer_state").agg(F.sum("rev_m").alias("rev_m"))
            .orderBy(F.desc("rev_m"), "customer_state").limit(k))


def tier_shares(tier: DataFrame) -> DataFrame:
    """D3 / A10: each tier's share of revenue and of customers."""
    return tier.select(
        "customer_tier",
        (F.col("revenue_m") / F.sum("revenue_m").over(_all()) * 100).alias("revenue_share_pct"),
        (F.col("customers") / F.sum("customers").over(_all()) * 100).alias("customer_share_pct"),
    )


# D4 ----------------------------------------------------------------------------------

def revenue_retention(disc: DataFrame) -> DataFrame:
    """Per-year net / gross %, plus all-year totals (billions) on every row."""
    return disc.select(
        "order_year",
        (F.col("net_rev") / F.col("gross_rev") * 100).alias("net_margin_pct"),
        (F.sum("gross_rev").over(_all()) / 1e9).alias("total_gross_bn"),
        (F.sum("net_rev").over(_all()) / 1e9).alias("total_net_bn"),
        (F.sum("discount_given").over(_all()) / 1e9).alias("total_discount_bn"),
        (F.sum("net_rev").over(_all()) / F.sum("gross_rev").over(_all()) * 100).alias("avg_retention_pct"),
        (F.sum("discount_given").over(_all()) / F.sum("gross_rev").over(_all()) * 100).alias("discount_pct_of_gross"),
    )


# D5 ----------------------------------------------------------------------------------

def health_scorecard(yearly: DataFrame, alert: DataFrame, newcust: DataFrame, disc: DataFrame) -> DataFrame:
    """RAG scorecard rows (item, value, status) from four small query outputs (a row per year at most), each
    computed once."""
    yearly, alert, newcust, disc = map(cut, (yearly, alert, newcust, disc))
    g = yearly_growth(yearly).where(F.col("yoy_pct").isNotNull()).agg(
        F.max_by("yoy_pct", "order_year").alias("v")).where(F.col("v").isNotNull())
    growth = g.select(F.lit("revenue_growth").alias("item"), F.col("v").alias("value"),
                      F.when(F.col("v") >= 5, "green").when(F.col("v") >= 0, "amber").otherwise("red").alias("status"))
    ret = F.coalesce(F.col("return_rate"), F.lit(0.0))
    dl = F.coalesce(F.col("avg_del"), F.lit(0.0))
    a_ret = alert.select(F.lit("return_rate").alias("item"), ret.alias("value"),
                         F.when(ret < 10, "green").when(ret < 15, "amber").otherwise("red").alias("status"))
    a_del = alert.select(F.lit("avg_delivery").alias("item"), dl.alias("value"),
                         F.when(dl <= 5, "green").when(dl <= 7, "amber").otherwise("red").alias("status"))
    a_aov = alert.select(F.lit("avg_order_value").alias("item"), F.coalesce("aov", F.lit(0.0)).alias("value"),
                         F.lit("green").alias("status"))
    w = Window.orderBy(F.desc("cohort_year"))
    last2 = newcust.select("new_customers", F.row_number().over(w).alias("rn")).where(F.col("rn") <= 2)
    acq = last2.agg(
        F.max(F.when(F.col("rn") == 1, F.col("new_customers"))).alias("last"),
        F.max(F.when(F.col("rn") == 2, F.col("new_customers"))).alias("prev"),
        F.count(F.lit(1)).alias("n"),
    ).where(F.col("n") > 0)
    grow = (F.col("n") == 2) & (F.col("last") > F.col("prev"))
    a_acq = acq.select(F.lit("customer_acquisition").alias("item"),
                       (F.col("last") - F.coalesce(F.col("prev"), F.lit(0))).cast("double").alias("value"),
                       F.when(grow, "green").otherwise("amber").alias("status"))
    d = disc.agg(F.max_by("avg_discount_pct", "order_year").alias("v"), F.count(F.lit(1)).alias("n")).where(
        F.col("n") > 0)
    a_disc = d.select(F.lit("discount_strategy").alias("item"), F.col("v").alias("value"),
                      F.when(F.col("v") < 20, "green").when(F.col("v") < 30, "amber").otherwise("red").alias("status"))
    return growth.unionByName(a_ret).unionByName(a_del).unionByName(a_aov).unionByName(a_acq).unionByName(a_disc)


# D10, D11, D12 -----------------------------------------------------------------------

def festival_share_by_year(festreg: DataFrame) -> DataFrame:
    """Festival revenue as % of the year's revenue."""
    tot = F.col("festival_rev_m") + F.col("regular_rev_m")
    return festreg.select("order_year", (F.col("festival_rev_m") / tot * 100).alias("festival_pct"))


def seasonality_summary(season: DataFrame) -> DataFrame:
    """Peak / low calendar month (by mean monthly revenue) and Oct-Dec share."""
    name = F.date_format(F.make_date(F.lit(2000), F.col("order_month"), F.lit(1)), "MMM")
    s = season.withColumn("month_name", name)
    return s.agg(
        _argmax("month_name", "avg_rev_m").alias("peak_month"),
        _argmin("month_name", "avg_rev_m").alias("low_month"),
        (F.sum(F.when(F.col("order_month").isin(10, 11, 12), F.col("avg_rev_m")).otherwise(0.0))
         / F.sum("avg_rev_m") * 100).alias("q4_share_pct"),
    )


def festival_top_subcategories(festsub: DataFrame, k: int = 10) -> DataFrame:
    """Top-k subcategories of each festival by revenue."""
    w = Window.partitionBy("festival_name").orderBy(F.desc("revenue_m"), "subcategory")
    return festsub.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# D13 ---------------------------------------------------------------------------------

def prime_lift(prime: DataFrame) -> DataFrame:
    """Prime AOV lift vs non-prime, prime revenue share, discount delta."""
    p, n = F.col("is_prime_member") == F.lit(True), F.col("is_prime_member") == F.lit(False)

    def pick(cond, c):
        return F.coalesce(F.max(F.when(cond, F.col(c))), F.lit(0.0))

    s = prime.agg(pick(p, "avg_order_value").alias("prime_aov"), pick(n, "avg_order_value").alias("non_prime_aov"),
                  pick(p, "revenue_m").alias("prime_rev"), F.sum("revenue_m").alias("total_rev"),
                  pick(p, "avg_discount").alias("prime_disc"), pick(n, "avg_discount").alias("non_prime_disc"))
    return s.select(
        "prime_aov", "non_prime_aov",
        ((F.col("prime_aov") / F.greatest(F.col("non_prime_aov"), F.lit(1.0)) - 1) * 100).alias("aov_lift_pct"),
        (F.col("prime_rev") / F.col("total_rev") * 100).alias("prime_revenue_share_pct"),
        (F.col("prime_disc") - F.col("non_prime_disc")).alias("discount_delta"),
    )


def prime_share_by_subcategory(primecat: DataFrame) -> DataFrame:
    """Prime customers' share of each subcategory's revenue."""
    return primecat.groupBy("subcategory").agg(
        (F.sum(F.when(F.col("is_prime_member") == F.lit(True), F.col("revenue_m")).otherwise(0.0))
         / F.sum("revenue_m") * 100).alias("prime_share_pct"))


# D15, D16 ----------------------------------------------------------------------------

def launch_year_totals(launch: DataFrame) -> DataFrame:
    """Revenue and product count per launch year."""
    return launch.groupBy("launch_year").agg(F.sum("revenue_m").alias("revenue_m"),
                                             F.sum("products").alias("products"))


def launch_year_mix(launch: DataFrame, year: int, k: int = 8) -> DataFrame:
    """Top-k subcategories of one launch year."""
    return (launch.where(F.col("launch_year") == year).orderBy(F.desc("revenue_m"), "subcategory").limit(k)
            .select("subcategory", "revenue_m"))


def return_rate_summary(returns: DataFrame) -> DataFrame:
    """Mean / worst / best subcategory return rate."""
    return returns.agg(
        F.avg("return_rate").alias("avg_return_rate"),
        _argmax("subcategory", "return_rate").alias("worst_subcategory"),
        F.max("return_rate").alias("worst_rate"),
        _argmin("subcategory", "return_rate").alias("best_subcategory"),
        F.min("return_rate").alias("best_rate"),
    )


# D17, D18, D19 -----------------------------------------------------------------------

FREQ_BANDS = ["1 order", "2 orders", "3-5 orders", "6-10 orders", "11-20 orders", "21+ orders"]


def _band(n):
    return (F.when(n == 1, FREQ_BANDS[0]).when(n == 2, FREQ_BANDS[1]).when(n <= 5, FREQ_BANDS[2])
            .when(n <= 10, FREQ_BANDS[3]).when(n <= 20, FREQ_BANDS[4]).otherwise(FREQ_BANDS[5]))


def frequency_bands(freq: DataFrame) -> DataFrame:
    """Customers per order-count band (all six bands, empty ones as 0) and share."""
    spark = freq.sparkSession
    bands = spark.createDataFrame([(b, i) for i, b in enumerate(FREQ_BANDS)], "bucket string, band_order int")
    got = freq.groupBy(_band(F.col("order_count")).alias("bucket")).agg(F.sum("customers").alias("customers"))
    j = bands.join(got, "bucket", "left").select("bucket", "band_order",
                                                F.coalesce("customers", F.lit(0)).cast("bigint").alias("customers"))
    return j.select("bucket", "band_order", "customers",
                    (F.col("customers") / F.sum("customers").over(_all()) * 100).alias("pct"))


def frequency_summary(freq: DataFrame) -> DataFrame:
    """One-time, repeat and loyal (11+) customer shares."""
    n = F.col("order_count")
    s = freq.agg(F.sum("customers").alias("t"),
                 F.sum(F.when(n == 1, F.col("customers")).otherwise(0)).alias("one"),
                 F.sum(F.when(n >= 11, F.col("customers")).otherwise(0)).alias("loyal"))
    one = F.col("one") / F.col("t") * 100
    return s.select(one.alias("one_time_pct"), (100 - one).alias("repeat_pct"),
                    (F.col("loyal") / F.col("t") * 100).alias("loyal_pct"))


def transition_row_pct(trans: DataFrame) -> DataFrame:
    """Transition counts as % of all transitions leaving the same category."""
    w = Window.partitionBy("from_cat")
    return trans.select("from_cat", "to_cat", (F.col("transitions") / F.sum("transitions").over(w) * 100).alias("pct"))


def top_transitions(trans: DataFrame, k: int = 8) -> DataFrame:
    """The k most frequent transitions."""
    return trans.orderBy(F.desc("transitions"), "from_cat", "to_cat").limit(k)


def scorecard_flags(score: DataFrame) -> DataFrame:
    """Below-median revenue, rating < 3.5, return rate > 10 flags per subcategory."""
    med = F.percentile("revenue_m", F.lit(0.5)).over(_all())
    return score.select(
        "subcategory",
        (F.col("revenue_m") < med).alias("below_median_revenue"),
        (F.coalesce("avg_rating", F.lit(0.0)) < 3.5).alias("low_rating"),
        (F.coalesce("return_rate", F.lit(0.0)) > 10).alias("high_return"),
    )


def scorecard_best(score: DataFrame) -> DataFrame:
    """Best performing, highest rated, lowest return rate subcategory."""
    return score.agg(_argmax("subcategory", "revenue_m").alias("best_performing"),
                     _argmax("subcategory", "avg_rating").alias("highest_rated"),
                     _argmin("subcategory", "return_rate").alias("lowest_return_rate"))


# D21, D22 ----------------------------------------------------------------------------

def transaction_vs_population(fact: DataFrame, summary: DataFrame) -> DataFrame:
    """Every transaction line against the population means / P95 of Q-ANOMSUM.

    The one-row summary enters as scalar subqueries (evaluated once, then used
    as constants), so no join is planned.
    """
    row = summary.select(F.struct(*summary.columns)).scalar()

    def sc(c):
        return row[c]

    d = F.col("discount_percent").cast("double")
    return fact.select(
        "transaction_id", "line_number", "product_id", "supplier_id",
        (d - sc("avg_discount_pct")).alias("discount_vs_mean"),
        (d > sc("p95_discount_pct")).alias("discount_above_p95"),
        (F.col("delivery_days") - sc("avg_delivery_days")).alias("delivery_vs_mean"),
        (F.col("delivery_days") > sc("p95_delivery_days")).alias("delivery_above_p95"),
    )


def monthly_series(mrev: DataFrame, sentinel_year: int = 1900) -> DataFrame:
    """Month-start date for the monthly revenue series, sentinel year dropped, sorted."""
    return (mrev.where(F.col("order_year") != sentinel_year)
            .select(F.make_date("order_year", "order_month", F.lit(1)).alias("month_start"), "revenue", "orders")
            .orderBy("month_start"))
