"""Registry entries for pricing (M18-M22, D8) and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as A
from ..operators import loading as L
from ..operators import pricing as P
from ..session import cut
from ..sources.star import load_star
from .oracle_star import star


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


def _points(sp, sf):
    return P.price_points(_a(sp, sf).fact, _a(sp, sf).products)


def _features(sp, sf):
    return P.demand_features(_points(sp, sf))


def _scenarios(sp, sf):
    return P.scenarios(P.elasticity(_features(sp, sf)))


def _demand_model(sp, sf):
    rows = cut(P.temporal_split(_features(sp, sf)))
    return P.fit_quality(P.train_demand(rows.where(~F.col("is_test")), trees=20), rows.where("is_test"))


def _lines(sp, sf):
    return A.anomaly_features(_a(sp, sf).fact.withColumn("line_key", L.line_key()), "line_key")


def _anomalies(sp, sf):
    rows = cut(_lines(sp, sf))
    rows = cut(A.scaled(rows, A.scaling(rows)))
    return A.flag(cut(A.score_samples(rows, A.grow_forest(rows, "line_key")))).select("line_key", "anomaly_score", "is_anomaly")


SPARK = {
    "m18_price_points": lambda sp, sf: _points(sp, sf).withColumns({
        "month": F.col("month").cast("string"), "price_inr": F.col("price_inr").cast("double")}),
    "m19_demand_features": lambda sp, sf: _features(sp, sf).withColumns({
        "month": F.col("month").cast("string"), **{c: F.round(c, 6) for c in ("avg_price_inr", "avg_mrp", "log_avg_price", "log_order_count")}}),
    "m20_elasticity": lambda sp, sf: P.elasticity(_features(sp, sf)).withColumns(
        {c: F.round(c, 6) for c in ("slope", "intercept", "r2", "price")}),
    "m20_temporal_split": lambda sp, sf: P.temporal_split(_features(sp, sf)).select(
        "subcategory", F.col("month").cast("string").alias("month"), "is_test"),
    "m20_demand_model": _demand_model,
    "m21_price_scenarios": _scenarios,
    "d8_best_price": lambda sp, sf: P.best_scenario(_scenarios(sp, sf)),
    "m22_price_buckets": lambda sp, sf: P.price_buckets(_points(sp, sf)).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("points"), F.min(F.col("price_inr").cast("double")).alias("low"), F.max(F.col("price_inr").cast("double")).alias("high")),
    "m28_anomaly_features": _lines,
    "m29_scaling": lambda sp, sf: A.scaling(_lines(sp, sf)).withColumns({c: F.round(c, 6) for c in ("mean", "std")}),
    # trees grown from hashed samples have no SQL form: rows only, with tests of their invariants
    "m31_anomalies": _anomalies,
    "a18_anomaly_summary": lambda sp, sf: A.score_summary(_anomalies(sp, sf)),
}

_POINTS = """
WITH pts AS (SELECT p.subcategory, CAST(date_trunc('month', f.order_date) AS DATE) AS month, f.final_amount_inr AS price,
                    f.original_price_inr AS mrp, COUNT(*) AS c
             FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id
             WHERE f.final_amount_inr > 0 AND f.original_price_inr > 0 AND p.subcategory IS NOT NULL GROUP BY ALL)"""
_FEATURES = _POINTS + """,
ft AS (SELECT subcategory, month, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price, CAST(SUM(c) AS BIGINT) AS orders, AVG(mrp) AS avg_mrp
       FROM pts GROUP BY ALL),
ln AS (SELECT *, ln(1 + avg_price) AS x, ln(1 + orders) AS y FROM ft)"""
_LINE = _FEATURES + """,
el AS (SELECT subcategory, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2, COUNT(*) AS months, AVG(avg_price) AS price
       FROM ln GROUP BY subcategory)"""
_SC = _LINE + """,
sc AS (SELECT subcategory, d AS delta_pct, price * (1 + d / CAST(100 AS DOUBLE)) AS p, exp(a + b * ln(1 + price * (1 + d / CAST(100 AS DOUBLE)))) - 1 AS q
       FROM el, (SELECT UNNEST([-20, -10, 0, 10, 20]) AS d) t),
rows_ AS (SELECT subcategory, delta_pct, ROUND(p, 2) AS price_inr, ROUND(q, 1) AS demand_estimate, ROUND(p * q, 2) AS revenue_estimate FROM sc)"""
_ANOM = """
WITH an AS (SELECT concat_ws('-', transaction_id, line_number, product_id, supplier_id) AS line_key, CAST(final_amount_inr AS DOUBLE) AS final_amount_inr,
                   LEAST(GREATEST(1 - CAST(final_amount_inr AS DOUBLE) / CAST(mrp_inr AS DOUBLE), 0), 1) AS discount_pct, delivery_days,
                   CAST(return_status = 'Returned' AS DOUBLE) AS is_return
            FROM fact_all WHERE mrp_inr > 0 AND final_amount_inr IS NOT NULL AND delivery_days IS NOT NULL)"""

RAW = {
    "m18_price_points": _POINTS + """
SELECT subcategory, CAST(month AS VARCHAR) AS month, CAST(price AS DOUBLE) AS price_inr, mrp AS mrp_inr, c AS order_count FROM pts""",
    "m19_demand_features": _FEATURES + """
SELECT subcategory, CAST(month AS VARCHAR) AS month, ROUND(avg_price, 6) AS avg_price_inr, orders AS order_count, ROUND(avg_mrp, 6) AS avg_mrp,
       CAST(month(month) AS DOUBLE) AS month_of_year, CAST(month(month) IN (10, 11) AS DOUBLE) AS is_festival_month,
       ROUND(x, 6) AS log_avg_price, ROUND(y, 6) AS log_order_count,
       CAST(DENSE_RANK() OVER (ORDER BY subcategory) - 1 AS INTEGER) AS subcategory_encoded FROM ln""",
    "m20_elasticity": _LINE + """
SELECT subcategory, ROUND(b, 6) AS slope, ROUND(a, 6) AS intercept, ROUND(r2, 6) AS r2, months, ROUND(price, 6) AS price FROM el""",
    "m20_temporal_split": _FEATURES + """
SELECT subcategory, CAST(month AS VARCHAR) AS month, month > (SELECT MAX(month) FROM ft) - INTERVAL 3 MONTH AS is_test FROM ft""",
    "m21_price_scenarios": _SC + "\nSELECT * FROM rows_",
    "d8_best_price": _SC + """
SELECT r.subcategory, r.delta_pct, r.price_inr, r.revenue_estimate, ROUND(r.revenue_estimate - z.revenue_estimate, 2) AS gain
FROM rows_ r JOIN rows_ z ON z.subcategory = r.subcategory AND z.delta_pct = 0
QUALIFY ROW_NUMBER() OVER (PARTITION BY r.subcategory ORDER BY r.revenue_estimate DESC, ABS(r.delta_pct), r.delta_pct) = 1""",
    "m22_price_buckets": _POINTS + """,
e AS (SELECT list_distinct(quantile_cont(CAST(price AS DOUBLE), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM pts)
SELECT CAST(GREATEST(len(list_filter(e, lambda v: v < CAST(price AS DOUBLE))) - 1, 0) AS INTEGER) AS bucket, COUNT(*) AS points,
       MIN(CAST(price AS DOUBLE)) AS low, MAX(CAST(price AS DOUBLE)) AS high FROM pts, e GROUP BY 1""",
    "m28_anomaly_features": _ANOM + "\nSELECT * FROM an",
    "m29_scaling": _ANOM + "\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(AVG({c}), 6) AS mean, ROUND(stddev_pop({c}), 6) AS std FROM an" for c in A.FEATURES),
}

ORACLE = {k: star(v) for k, v in RAW.items()}
