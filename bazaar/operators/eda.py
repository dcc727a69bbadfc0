"""Exploratory analyses: the tables behind the EDA charts.

Like the reference's EDA SQL, these read the fact table without the sentinel
filter (quirk Q4); callers pass ``load_star(..., exclude_sentinel=False)``.
Row caps the reference used for plotting (LIMIT 10 000 / 20 000) are not
applied: every analysis runs over the whole table.

Whole-table windows below always run on a small aggregated table (one row per year or subcategory); ranks, running
sums and quantiles over products or customers use running totals over buckets of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.aggs import dmean, dsum
from ..sources.star import in_years
from ..functions.ranks import exact_quantiles, running_totals, value_rank_table
from ..functions.stats import box_stats, cut, equal_width_bin
from ..session import cut as cut_lineage

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
AGE_ORDER = ["18-25", "26-35", "36-45", "46-55", "55+"]
def _all():
    return Window.partitionBy()  # whole-table window; only used on aggregated tables


def _with_sub(fact: DataFrame, products: DataFrame, *cols: str) -> DataFrame:
    return fact.select("product_id", *cols).join(products.select("product_id", "subcategory"), "product_id")


def revenue_trend(fact: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Yearly revenue (bn), rows and YoY %."""
    y = in_years(fact, first_year, last_year).groupBy("order_year").agg(
        (dsum("final_amount_inr") / 1e9).alias("rev"), F.count(F.lit(1)).alias("orders"))
    return y.withColumn("yoy", (F.col("rev") / F.lag("rev").over(Window.orderBy("order_year")) - 1) * 100)


def year_month_matrix(fact: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Year x month revenue (millions), months as columns, missing as 0."""
    p = (in_years(fact, first_year, last_year).groupBy("order_year")
         .pivot("order_month", list(range(1, 13))).agg(F.sum("final_amount_inr")))
    return p.select("order_year", *[F.coalesce(F.col(str(m)).cast("double") / 1e6, F.lit(0.0)).alias(MONTHS[m - 1])
                                    for m in range(1, 13)])


def _qcut_or_rank(df: DataFrame, value: str, key: str, out: str, ascending: bool, q: int = 5) -> DataFrame:
    """pandas ``qcut(q)`` labels 1..q (or q..1), falling back to an equal-width cut of
    ``rank(method='first')`` when quantile edges repeat (the EDA's ``safe_qcut``).

    Edges are exact interpolated quantiles from running counts; one row of them decides between the two ways, so
    ranks are only computed where they are used.  The rank orders by (value, key), also in running counts.
    """
    row = exact_quantiles(df, [], value, [i / q for i in range(q + 1)]).first()
    if row is None or row["n"] is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    e, n = row["q"], row["n"]
    if len(set(e)) == q + 1:
        # bin i covers (e[i-1], e[i]], the first bin also includes e[0]
        b = F.lit(None).cast("int")
        for i in range(q, 0, -1):
            above = F.col(value) >= e[0] if i == 1 else F.col(value) > e[i - 1]
            b = F.when(above & (F.col(value) <= e[i]), F.lit(i)).otherwise(b)
        j = df
    else:
        less = value_rank_table(df, value).select(F.col("v").alias("_v"), "n_less")
        ties = running_totals(df.select(F.col(value).cast("double").alias("_v"), F.col(key).alias("_k"),
                                        F.lit(1).alias("_one")), ["_v"], "_k", ["_one"])
        r = ties.join(less, "_v").select("_k", (F.col("n_less") + F.col("_one_before") + 1).alias("_r"))
        j = df.join(r, F.col(key) == F.col("_k")).drop("_k")
        width = F.lit((n - 1) / q)
        b = F.lit(1) if n == 1 else F.least(F.greatest(F.ceil((F.col("_r") - 1) / width), F.lit(1)), F.lit(q))
    b = b.cast("int")
    return j.withColumn(out, b if ascending else (F.lit(q + 1) - b)).select(*df.columns, out)


def rfm_eda_segments(fact: DataFrame) -> DataFrame:
    """RFM of the EDA notebook: yyyymm recency, qcut scores, 4 rules else 'Hibernating'."""
    c = fact.groupBy("customer_id").agg(
        F.max(F.col("order_year") * 100 + F.col("order_month")).alias("lp"),
        F.count(F.lit(1)).alias("freq"), dsum("final_amount_inr").alias("mon"))
    c = cut_lineage(c)
    c = c.withColumn("recency", c.agg(F.max("lp").alias("m")).scalar() - F.col("lp"))
    c = _qcut_or_rank(c, "recency", "customer_id", "r_s", ascending=False)
    c = _qcut_or_rank(c, "freq", "customer_id", "f_s", ascending=True)
    c = _qcut_or_rank(c, "mon", "customer_id", "m_s", ascending=True)
    r, f, m = F.col("r_s"), F.col("f_s"), F.col("m_s")
    seg = (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions").when((r >= 3) & (f >= 3) & (m >= 3), "Loyal")
           .when((r >= 4) & (f <= 2), "Promising").when((r <= 2) & (f >= 3), "At Risk").otherwise("Hibernating"))
    return c.select("customer_id", "recency", "freq", "mon", "r_s", "f_s", "m_s", seg.alias("segment"))


def payment_share_by_year(fact: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Payment method share (%) within each year."""
    g = in_years(fact, first_year, last_year).groupBy("order_year", "payment_method").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy("order_year")) * 100)


def subcategory_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """E5: revenue (bn) and share of total per subcategory."""
    by_p = fact.groupBy("product_id").agg(F.sum("final_amount_inr").alias("_r"))
    s = by_p.join(products.select("product_id", "subcategory"), "product_id").groupBy("subcategory").agg(
        F.sum("_r").alias("_r"))
    return s.select("subcategory", (F.col("_r").cast("double") / 1e9).alias("rev"),
                    (F.col("_r").cast("double") / F.sum("_r").over(_all()).cast("double") * 100).alias("share_pct"))


def subcategory_yearly_growth(fact: DataFrame, products: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Yearly revenue (millions) per subcategory, YoY %, and the peak year per subcategory."""
    by_p = in_years(fact, first_year, last_year).groupBy("product_id", "order_year").agg(
        F.sum("final_amount_inr").alias("_r"))
    s = (by_p.join(products.select("product_id", "subcategory"), "product_id")
         .groupBy("order_year", "subcategory").agg((dsum("_r") / 1e6).alias("rev")))
    w = Window.partitionBy("subcategory").orderBy("order_year")
    peak = F.first("order_year").over(Window.partitionBy("subcategory").orderBy(F.desc("rev"), "order_year")
                                      .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.select("order_year", "subcategory", "rev", ((F.col("rev") / F.lag("rev").over(w) - 1) * 100).alias("yoy"),
                    peak.alias("peak_year"))


def prime_impact(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """AOV, rows, customers and rows per customer by prime flag."""
    j = fact.select("customer_id", "final_amount_inr").join(customers.select("customer_id", "is_prime_member"),
                                                            "customer_id")
    g = j.groupBy("is_prime_member").agg(dmean("final_amount_inr").alias("aov"), F.count(F.lit(1)).alias("orders"),
                                         F.countDistinct("customer_id").alias("custs"))
    return g.withColumn("freq", F.col("orders") / F.col("custs"))


def revenue_by_dim(fact: DataFrame, customers: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Revenue (bn) by a customer attribute, optionally top-k (pre-aggregated per customer)."""
    by_c = fact.groupBy("customer_id").agg(F.sum("final_amount_inr").alias("_r"))
    g = by_c.join(customers.select("customer_id", key), "customer_id").groupBy(key).agg((dsum("_r") / 1e9).alias("rev"))
    g = g.orderBy(F.desc("rev"), key)
    return g.limit(k) if k else g


def festival_split(fact: DataFrame) -> DataFrame:
    """Mean, count, sum of order value for festival vs regular sales."""
    return fact.groupBy("is_festival_sale").agg(dmean("final_amount_inr").alias("mean"),
                                                F.count("final_amount_inr").alias("count"),
                                                dsum("final_amount_inr").alias("sum"))


def festival_revenue(fact: DataFrame) -> DataFrame:
    """Revenue (millions) by festival, festival sales only."""
    return (fact.where(F.col("is_festival_sale") == F.lit(True)).groupBy("festival_name")
            .agg((dsum("final_amount_inr") / 1e6).alias("rev_m")))


def order_value_by_tier(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Box statistics of line value per customer tier."""
    j = fact.select("customer_id", F.col("final_amount_inr").cast("double").alias("v")).join(
        customers.select("customer_id", "customer_tier"), "customer_id")
    return box_stats(j, "customer_tier", "v")


def payment_mix_by_tier(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Payment method share (%) within each customer tier."""
    j = fact.select("customer_id", "payment_method").join(customers.select("customer_id", "customer_tier"),
                                                          "customer_id")
    g = j.groupBy("customer_tier", "payment_method").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy("customer_tier")) * 100)


def age_subcategory_matrix(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Age group x subcategory revenue (millions), in logical age order."""
    by = (fact.select("customer_id", "product_id", "final_amount_inr")
          .join(customers.select("customer_id", "customer_age_group"), "customer_id")
          .groupBy("customer_age_group", "product_id").agg(F.sum("final_amount_inr").alias("_r"))
          .join(products.select("product_id", "subcategory"), "product_id")
          .groupBy("customer_age_group", "subcategory").agg((dsum("_r") / 1e6).alias("rev")))
    order = F.array_position(F.array(*[F.lit(a) for a in AGE_ORDER]), F.col("customer_age_group"))
    return by.where(order > 0).withColumn("age_order", order.cast("int")).orderBy("age_order", "subcategory")


def price_demand_correlation(fact: DataFrame) -> DataFrame:
    """Pearson correlation of price, discount and quantity (all rows), rounded to 1e-9."""
    cols = ["discounted_price_inr", "discount_percent", "quantity"]
    f = fact.select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = f.agg(*[F.round(F.corr(a, b), 9).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (var_a, var_b, corr)")


def top_brands(fact: DataFrame, products: DataFrame, k: int = 15) -> DataFrame:
    """Top-k brands by revenue with mean discount and rating."""
    # a task sees a product about once, so sums by product would shuffle wider rows than the lines are; the products of a
    # partition are few, so lines need no sort to meet them
    lines = fact.select("product_id", "final_amount_inr", "discount_percent", "product_rating")
    g = lines.join(products.select("product_id", "brand").hint("shuffle_hash"), "product_id").groupBy("brand").agg(
        (dsum("final_amount_inr") / 1e9).alias("rev"), dmean("discount_percent").alias("disc"), dmean("product_rating").alias("rating"))
    return g.orderBy(F.desc("rev"), "brand").limit(k)


def return_rate_by(fact: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """Return rate (%) by subcategory or payment method."""
    f = _with_sub(fact, products, "return_status", "payment_method") if key == "subcategory" else fact
    return f.groupBy(key).agg((F.sum(F.when(F.col("return_status") == "Returned", 1).otherwise(0)).cast("double")
                               / F.count(F.lit(1)) * 100).alias("rate"))


def cohort_retention(fact: DataFrame, first_year: int, last_year: int, min_size: int = 0) -> DataFrame:
    """Distinct customers of each first-purchase cohort active per year, as % of the cohort size.

    Intended version of quirk Q3: divided by the cohort's own first-year size
    (the notebook divides every cohort by the first year column).  All cohorts
    are returned; a plot may ask for those of ``min_size`` customers or more.  ``min(year)`` per customer is a
    window over the customer partition, so no join back is needed.
    """
    f = in_years(fact, first_year, last_year).select("customer_id", "order_year").distinct()
    f = f.withColumn("cohort", F.min("order_year").over(Window.partitionBy("customer_id")))
    m = f.groupBy("cohort", "order_year").agg(F.count(F.lit(1)).alias("customers"))
    size = F.max(F.when(F.col("order_year") == F.col("cohort"), F.col("customers"))).over(Window.partitionBy("cohort"))
    m = m.withColumn("cohort_size", size)
    return (m.where(F.col("cohort_size") >= min_size)
            .select("cohort", "order_year", "customers", (F.col("customers") / F.col("cohort_size") * 100).alias("pct")))


def clv_distribution(fact: DataFrame, bins: int = 50) -> DataFrame:
    """Customer value histogram after clipping at P99; mean and median of the unclipped values."""
    c = cut_lineage(fact.groupBy("customer_id").agg(F.sum("final_amount_inr").cast("double").alias("clv")))
    s = exact_quantiles(c, [], "clv", [0.99, 0.5]).select(F.struct(F.col("q")[0].alias("cap"), F.col("q")[1].alias("median")))
    s = s.scalar()
    m = c.agg(F.struct(F.avg("clv").alias("mean"), F.min("clv").alias("lo"), F.max("clv").alias("hi"))).scalar()
    b = equal_width_bin(F.least(F.col("clv"), s["cap"]), F.least(m["lo"], s["cap"]), F.least(m["hi"], s["cap"]), bins)
    h = c.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
    return h.select("bin", "customers", F.round(s["cap"], 4).alias("p99_cap"), F.round(m["mean"], 4).alias("mean_clv"),
                    F.round(s["median"], 4).alias("median_clv"))


def delivery_by_type(fact: DataFrame) -> DataFrame:
    """Box statistics of delivery days per delivery type."""
    return box_stats(fact.where(F.col("delivery_days").isNotNull()), "delivery_type", "delivery_days")


def delivery_by_tier(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean delivery days per customer tier."""
    j = fact.where(F.col("delivery_days").isNotNull()).select("customer_id", "delivery_days").join(
        customers.select("customer_id", "customer_tier"), "customer_id")
    return j.groupBy("customer_tier").agg(F.avg("delivery_days").alias("avg_days"))


def discount_bins(fact: DataFrame, edges, labels) -> DataFrame:
    """Right-closed discount bins; mean quantity and revenue (millions) per bin."""
    d = fact.where(F.col("discount_percent").isNotNull()).withColumn(
        "disc_bin", cut(F.col("discount_percent"), edges, labels))
    return d.where(F.col("disc_bin").isNotNull()).groupBy("disc_bin").agg(
        dmean("quantity").alias("avg_quantity"), (dsum("final_amount_inr") / 1e6).alias("rev_m"))


def rating_by_subcategory(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Box statistics of product rating per subcategory."""
    return box_stats(_with_sub(fact.where(F.col("product_rating").isNotNull()), products, "product_rating"),
                     "subcategory", "product_rating")


def pareto(fact: DataFrame, share: float = 80.0) -> DataFrame:
    """Smallest % of products (by revenue, descending) whose cumulative share stays <= 80 %.

    Running sums over distinct revenues; of products with equal revenue, as many count as still fit.
    """
    p = fact.groupBy("product_id").agg(F.sum("final_amount_inr").alias("rev"))
    r = p.groupBy((-F.col("rev")).alias("neg")).agg(F.count(F.lit(1)).alias("n"), F.sum("rev").alias("s"))
    r = running_totals(r, [], "neg", ["n", "s"])
    each, whole = -F.col("neg").cast("double"), F.col("s_total").cast("double")
    room = whole * (share / 100.0) - F.col("s_before").cast("double")
    # products without revenue add nothing: all of them fit where there is room left
    fit = F.when(each == 0, F.when(room >= 0, F.col("n")).otherwise(0)).otherwise(F.floor(F.try_divide(room, each)))
    taken = F.least(F.greatest(fit, F.lit(0)), F.col("n"))
    pp = F.when(taken > 0, (F.col("n_before") + taken) / F.col("n_total") * 100)
    return r.agg(F.coalesce(F.max(pp), F.lit(100.0)).alias("top_pct_products"), F.max("n_total").alias("products"))


FREQ_EDGES_LABELS = ["1", "2", "3-4", "5-9", "10-19", "20-49", "50+"]


def frequency_buckets(fact: DataFrame) -> DataFrame:
    """Left-closed order-count buckets [1,2,3,5,10,20,50,max+1) with the labels fixed (quirk Q9)."""
    c = fact.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    b = (F.when(n < 2, "1").when(n < 3, "2").when(n < 5, "3-4").when(n < 10, "5-9").when(n < 20, "10-19")
         .when(n < 50, "20-49").otherwise("50+"))
    return c.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("customers"),
                                            F.sum(F.when(n == 1, 1).otherwise(0)).alias("one_time"))


def category_transitions_pct(fact: DataFrame, products: DataFrame, column: str = "category") -> DataFrame:
    """Transition row % on a product attribute (the notebook uses ``category``, quirk Q14)."""
    j = fact.select("customer_id", "product_id", "order_date", "transaction_id", "line_number", "supplier_id").join(
        products.select("product_id", F.col(column).alias("cat")).where(F.col("cat").isNotNull()), "product_id")
    w = Window.partitionBy("customer_id").orderBy("order_date", "transaction_id", "line_number", "product_id",
                                                  "supplier_id")
    t = j.select(F.col("cat").alias("from_cat"), F.lead("cat").over(w).alias("to_cat")).where(F.col("to_cat").isNotNull())
    g = t.groupBy("from_cat", "to_cat").agg(F.count(F.lit(1)).alias("transitions"))
    return g.withColumn("pct", F.col("transitions") / F.sum("transitions").over(Window.partitionBy("from_cat")) * 100)


def revenue_by_product_age(fact: DataFrame, products: DataFrame, anchor_year: int, first: int,
                           last: int) -> DataFrame:
    """Revenue (millions) and rows by product age = anchor - launch year."""
    by_p = fact.groupBy("product_id").agg(F.sum("final_amount_inr").alias("_r"), F.count(F.lit(1)).alias("_n"))
    p = products.where(F.col("launch_year").between(first, last)).select(
        "product_id", (F.lit(anchor_year) - F.col("launch_year")).alias("product_age"))
    return by_p.join(p, "product_id").groupBy("product_age").agg((dsum("_r") / 1e6).alias("rev_m"),
                                                                  F.sum("_n").alias("orders"))


def quadratic_trend(points: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares y = a x^2 + b x + c from power sums (Cramer's rule on the 3x3 normal equations)."""
    X, Y = F.col(x).cast("double"), F.col(y).cast("double")
    s = points.agg(F.count(F.lit(1)).cast("double").alias("s0"), F.sum(X).alias("s1"), F.sum(X * X).alias("s2"),
                   F.sum(X * X * X).alias("s3"), F.sum(X * X * X * X).alias("s4"), F.sum(Y).alias("t0"),
                   F.sum(X * Y).alias("t1"), F.sum(X * X * Y).alias("t2"))
    c = {k: F.col(k) for k in ["s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"]}

    def det3(a, b, cc, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + cc * (d * h - e * g)

    # normal equations: [s4 s3 s2; s3 s2 s1; s2 s1 s0] [a b c]' = [t2 t1 t0]'
    D = det3(c["s4"], c["s3"], c["s2"], c["s3"], c["s2"], c["s1"], c["s2"], c["s1"], c["s0"])
    Da = det3(c["t2"], c["s3"], c["s2"], c["t1"], c["s2"], c["s1"], c["t0"], c["s1"], c["s0"])
    Db = det3(c["s4"], c["t2"], c["s2"], c["s3"], c["t1"], c["s1"], c["s2"], c["t0"], c["s0"])
    Dc = det3(c["s4"], c["s3"], c["t2"], c["s3"], c["s2"], c["t1"], c["s2"], c["s1"], c["t0"])
    return s.select(F.round(Da / D, 6).alias("a"), F.round(Db / D, 6).alias("b"), F.round(Dc / D, 6).alias("c"))


def price_percentiles(fact: DataFrame, products: DataFrame, max_price: float = 500000.0) -> DataFrame:
    """List price p25 / median / p75 / min / max per subcategory, 0 < price < max."""
    f = _with_sub(fact.where((F.col("original_price_inr") > 0) & (F.col("original_price_inr") < max_price)),
                  products, "original_price_inr")
    g = f.groupBy("subcategory").agg(F.min("original_price_inr").alias("min_p"), F.max("original_price_inr").alias("max_p"))
    g = g.join(exact_quantiles(f, ["subcategory"], "original_price_inr", [0.25, 0.5, 0.75]), "subcategory")
    return g.select("subcategory", F.round(F.col("q")[0], 6).alias("p25"), F.round(F.col("q")[1], 6).alias("median"),
                    F.round(F.col("q")[2], 6).alias("p75"), "min_p", "max_p")


def brand_price_boxes(fact: DataFrame, products: DataFrame, k: int = 10, max_price: float = 500000.0) -> DataFrame:
    """Box statistics of list price for the k brands with the most SKUs (semi-join)."""
    top = (products.where(F.col("brand").isNotNull()).groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "brand").limit(k).select("brand"))
    p = products.select("product_id", "brand").join(top, "brand", "left_semi")
    f = fact.where((F.col("original_price_inr") > 0) & (F.col("original_price_inr") < max_price)).select(
        "product_id", "original_price_inr").join(p, "product_id")
    b = box_stats(f, "brand", "original_price_inr")
    return b.select("brand", "n", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3", "whisker_low",
                                                                       "whisker_high"]])


def age_pivot(age_subcategory: DataFrame) -> DataFrame:
    """The known age groups in their order with every subcategory, missing pairs as 0 (long form of the pivot).

    ``age_subcategory(customer_age_group, subcategory, revenue_m)`` has a row per pair, so the pivot is small.
    """
    # stored, as the pivot reads its pairs twice: once for the names of the columns
    known = cut_lineage(age_subcategory.where(F.col("customer_age_group").isin(*AGE_ORDER)))
    wide = known.groupBy("customer_age_group").pivot("subcategory").agg(F.sum("revenue_m")).na.fill(0.0)
    names = [c for c in wide.columns if c != "customer_age_group"]
    order = F.array_position(F.array(*map(F.lit, AGE_ORDER)), F.col("customer_age_group")).cast("int") - 1
    long = wide.unpivot(["customer_age_group"], names, "subcategory", "revenue_m")
    return long.withColumn("age_order", order).orderBy("age_order", "subcategory")
