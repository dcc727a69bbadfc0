"""Price and demand: monthly aggregates, elasticity, demand trees, price scenarios, price buckets."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggs import dmean
from ..functions.ranks import exact_quantiles
from .churn import encode, ordinal_codes

# Festival months and the price changes of a scenario.
FESTIVAL_MONTHS = (10, 11)
DELTAS = (-20, -10, 0, 10, 20)

FEATURES = ["log_avg_price", "month_of_year", "is_festival_month", "subcategory_encoded"]


def price_points(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Rows per subcategory, month, price paid and list price (all present and positive)."""
    f = fact.where(F.col("order_date").isNotNull() & (F.col("final_amount_inr") > 0) & (F.col("original_price_inr") > 0))
    f = f.select("product_id", F.trunc("order_date", "month").alias("month"), F.col("final_amount_inr").alias("price_inr"),
                 F.col("original_price_inr").alias("mrp_inr"))
    j = f.join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    return j.groupBy("subcategory", "month", "price_inr", "mrp_inr").agg(F.count(F.lit(1)).alias("order_count"))


def demand_features(points: DataFrame) -> DataFrame:
    """Per subcategory and month the plain mean over price points, orders, logs, season and subcategory code."""
    g = points.groupBy("subcategory", "month").agg(
        dmean("price_inr").alias("avg_price_inr"), F.sum("order_count").alias("order_count"), F.avg("mrp_inr").alias("avg_mrp"))
    g = g.withColumn("month_of_year", F.month("month").cast("double"))
    g = g.withColumn("is_festival_month", F.col("month_of_year").isin(*FESTIVAL_MONTHS).cast("double"))
    g = g.withColumn("log_avg_price", F.log1p("avg_price_inr")).withColumn("log_order_count", F.log1p("order_count"))
    return encode(g.withColumn("subcategory_encoded", F.col("subcategory")), "subcategory_encoded", ordinal_codes(points, "subcategory"))


def temporal_split(features: DataFrame, months: int = 3) -> DataFrame:
    """``is_test`` for the last months."""
    last = features.agg(F.max("month").alias("m")).scalar()
    return features.withColumn("is_test", F.col("month") > F.add_months(last, -months))


def elasticity(features: DataFrame) -> DataFrame:
    """Least-squares line of log orders over log price per subcategory; its slope is the price elasticity."""
    x, y = F.col("log_avg_price"), F.col("log_order_count")
    return features.groupBy("subcategory").agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.count(F.lit(1)).alias("months"), F.avg("avg_price_inr").alias("price"))


def train_demand(train: DataFrame, trees: int = 50, depth: int = 4) -> GBTRegressionModel:
    """Boosted regression trees of log orders."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(train)
    return GBTRegressor(featuresCol="_x", labelCol="log_order_count", maxIter=trees, maxDepth=depth, stepSize=0.05, seed=42).fit(rows)


def fit_quality(model: GBTRegressionModel, test: DataFrame) -> DataFrame:
    """R2 and RMSE on held-out months."""
    p = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(test))
    err, y = F.col("log_order_count") - F.col("prediction"), F.col("log_order_count")
    return p.agg((1 - F.sum(err * err) / (F.var_pop(y) * F.count(y))).alias("r2"), F.sqrt(F.avg(err * err)).alias("rmse"),
                 F.count(F.lit(1)).alias("months"))


def _rounded(rows: DataFrame) -> DataFrame:
    """Price (2 digits), demand (1), revenue (2) of scenario rows (subcategory, delta_pct, price, log_demand)."""
    demand = F.exp("log_demand") - 1
    return rows.select("subcategory", "delta_pct", F.round("price", 2).alias("price_inr"), F.round(demand, 1).alias("demand_estimate"),
                       F.round(F.col("price") * demand, 2).alias("revenue_estimate"))


def _changed(prices: DataFrame) -> DataFrame:
    each = prices.withColumn("delta_pct", F.explode(F.array(*map(F.lit, DELTAS))))
    return each.withColumn("price", F.col("price") * (1 + F.col("delta_pct") / 100.0))


def scenarios(lines: DataFrame) -> DataFrame:
    """Demand and revenue at changed prices from each subcategory's elasticity line."""
    return _rounded(_changed(lines).withColumn("log_demand", F.col("intercept") + F.col("slope") * F.log1p("price")))


def model_scenarios(model: GBTRegressionModel, prices: DataFrame, month: int) -> DataFrame:
    """The same from the trees; ``prices(subcategory, subcategory_encoded, price)`` in a month."""
    rows = _changed(prices).withColumns({
        "log_avg_price": F.log1p("price"), "month_of_year": F.lit(float(month)),
        "is_festival_month": F.lit(float(month in FESTIVAL_MONTHS))})
    p = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(rows))
    return _rounded(p.withColumn("log_demand", F.col("prediction")))


def best_scenario(rows: DataFrame) -> DataFrame:
    """The price change of most revenue per subcategory (the smaller change of equals) and the gain over no change."""
    now = F.max(F.when(F.col("delta_pct") == 0, F.col("revenue_estimate")))
    best = F.max_by(F.struct("delta_pct", "price_inr", "revenue_estimate"), F.struct("revenue_estimate", -F.abs("delta_pct"), -F.col("delta_pct")))
    g = rows.groupBy("subcategory").agg(best.alias("b"), now.alias("now"))
    return g.select("subcategory", "b.delta_pct", "b.price_inr", "b.revenue_estimate",
                    F.round(F.col("b.revenue_estimate") - F.col("now"), 2).alias("gain"))


def price_buckets(points: DataFrame, bins: int = 10) -> DataFrame:
    """The points with their price's quantile bucket (0 to bins - 1; equal edges count once)."""
    edges = exact_quantiles(points, [], "price_inr", [i / bins for i in range(bins + 1)]).select(F.array_distinct("q").alias("e")).scalar()
    price = F.col("price_inr").cast("double")
    b = points.withColumn("_e", edges).withColumn("bucket", F.greatest(F.size(F.filter("_e", lambda e: e < price)) - 1, F.lit(0)))
    return b.drop("_e")
