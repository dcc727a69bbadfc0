"""Registry entries for the EDA analyses (E1-E23); the reference's EDA reads all rows (quirk Q4)."""

from __future__ import annotations

from ..operators import eda
from ..sources.star import load_star
from .named import FIRST_YEAR, LAST_YEAR
from .oracle_star import star

DISC_EDGES = [0, 2, 4, 6, 8, 10]
DISC_LABELS = ["0-2", "2-4", "4-6", "6-8", "8-10"]
AGE_ANCHOR, LAUNCH_FIRST, LAUNCH_LAST = 2001, 1985, 1995


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


Y = (FIRST_YEAR, LAST_YEAR)

SPARK = {
    "e1_revenue_trend": lambda sp, sf: eda.revenue_trend(_a(sp, sf).fact, *Y),
    "e2_year_month": lambda sp, sf: eda.year_month_matrix(_a(sp, sf).fact, *Y),
    "e3_rfm_segments": lambda sp, sf: eda.rfm_eda_segments(_a(sp, sf).fact),
    "e4_payment_share": lambda sp, sf: eda.payment_share_by_year(_a(sp, sf).fact, *Y),
    "e5_subcategory_perf": lambda sp, sf: eda.subcategory_performance(_a(sp, sf).fact, _a(sp, sf).products),
    "e5_subcategory_yearly": lambda sp, sf: eda.subcategory_yearly_growth(_a(sp, sf).fact, _a(sp, sf).products, *Y),
    "e6_prime_impact": lambda sp, sf: eda.prime_impact(_a(sp, sf).fact, _a(sp, sf).customers),
    "e7_top_states": lambda sp, sf: eda.revenue_by_dim(_a(sp, sf).fact, _a(sp, sf).customers, "customer_state", 15),
    "e7_tiers": lambda sp, sf: eda.revenue_by_dim(_a(sp, sf).fact, _a(sp, sf).customers, "customer_tier"),
    "e8_festival_split": lambda sp, sf: eda.festival_split(_a(sp, sf).fact),
    "e8_festival_revenue": lambda sp, sf: eda.festival_revenue(_a(sp, sf).fact),
    "e9_value_by_tier": lambda sp, sf: eda.order_value_by_tier(_a(sp, sf).fact, _a(sp, sf).customers),
    "e9_payment_by_tier": lambda sp, sf: eda.payment_mix_by_tier(_a(sp, sf).fact, _a(sp, sf).customers),
    "e10_age_subcategory": lambda sp, sf: eda.age_subcategory_matrix(_a(sp, sf).fact, _a(sp, sf).customers,
                                                                     _a(sp, sf).products),
    "e11_correlation": lambda sp, sf: eda.price_demand_correlation(_a(sp, sf).fact),
    "e12_top_brands": lambda sp, sf: eda.top_brands(_a(sp, sf).fact, _a(sp, sf).products, 15),
    "e13_returns_subcategory": lambda sp, sf: eda.return_rate_by(_a(sp, sf).fact, _a(sp, sf).products, "subcategory"),
    "e13_returns_payment": lambda sp, sf: eda.return_rate_by(_a(sp, sf).fact, _a(sp, sf).products, "payment_method"),
    "e14_cohort_retention": lambda sp, sf: eda.cohort_retention(_a(sp, sf).fact, *Y),
    "e15_clv_distribution": lambda sp, sf: eda.clv_distribution(_a(sp, sf).fact),
    "e16_delivery_by_type": lambda sp, sf: eda.delivery_by_type(_a(sp, sf).fact),
    "e16_delivery_by_tier": lambda sp, sf: eda.delivery_by_tier(_a(sp, sf).fact, _a(sp, sf).customers),
    "e17_discount_bins": lambda sp, sf: eda.discount_bins(_a(sp, sf).fact, DISC_EDGES, DISC_LABELS),
    "e18_rating_by_subcategory": lambda sp, sf: eda.rating_by_subcategory(_a(sp, sf).fact, _a(sp, sf).products),
    "e19_pareto": lambda sp, sf: eda.pareto(_a(sp, sf).fact),
    "e21_frequency_buckets": lambda sp, sf: eda.frequency_buckets(_a(sp, sf).fact),
    "e21_category_transitions": lambda sp, sf: eda.category_transitions_pct(_a(sp, sf).fact, _a(sp, sf).products),
    "e22_product_age": lambda sp, sf: eda.revenue_by_product_age(_a(sp, sf).fact, _a(sp, sf).products, AGE_ANCHOR,
                                                                 LAUNCH_FIRST, LAUNCH_LAST),
    "e22_quadratic_trend": lambda sp, sf: eda.quadratic_trend(
        eda.revenue_by_product_age(_a(sp, sf).fact, _a(sp, sf).products, AGE_ANCHOR, LAUNCH_FIRST, LAUNCH_LAST),
        "product_age", "rev_m"),
    "e23_price_percentiles": lambda sp, sf: eda.price_percentiles(_a(sp, sf).fact, _a(sp, sf).products),
    "e23_brand_price_boxes": lambda sp, sf: eda.brand_price_boxes(_a(sp, sf).fact, _a(sp, sf).products, 10),
}

_F = "fact_all"
_YW = f"order_year BETWEEN {FIRST_YEAR} AND {LAST_YEAR}"
_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _box(src: str, key: str, val: str, rnd: bool = False) -> str:
    r = (lambda c: f"ROUND({c}, 6)") if rnd else (lambda c: c)
    return f"""WITH src AS ({src}),
q AS (SELECT {key}, COUNT(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM src GROUP BY {key}),
w AS (SELECT s.{key}, MIN(CASE WHEN s.v >= q.q1 - 1.5 * (q.q3 - q.q1) THEN s.v END) AS whisker_low,
             MAX(CASE WHEN s.v <= q.q3 + 1.5 * (q.q3 - q.q1) THEN s.v END) AS whisker_high
      FROM src s JOIN q ON s.{key} = q.{key} GROUP BY s.{key})
SELECT q.{key}, q.n, {r('q.q1')} AS q1, {r('q.median')} AS median, {r('q.q3')} AS q3,
       {r('w.whisker_low')} AS whisker_low, {r('w.whisker_high')} AS whisker_high
FROM q JOIN w ON q.{key} = w.{key}"""


def _qcut(src: str, val: str, out: str, asc: bool) -> str:
    bins = " ".join(
        f"WHEN {val} {'>=' if i == 1 else '>'} e[{i}] AND {val} <= e[{i + 1}] THEN {i}" for i in range(1, 6))
    lab = "b" if asc else "6 - b"
    return f"""SELECT *, {lab.replace('b', f'''(CASE WHEN len(list_distinct(e)) = 6 THEN (CASE {bins} END)
  ELSE (CASE WHEN cnt = 1 THEN 1 ELSE LEAST(GREATEST(CEIL((rn - 1) / ((cnt - 1) / 5)), 1), 5) END) END)''')} AS {out}
FROM (SELECT *, (SELECT quantile_cont({val}, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) FROM {src}) AS e,
             ROW_NUMBER() OVER (ORDER BY {val}, customer_id) AS rn, COUNT(*) OVER () AS cnt FROM {src})"""


RAW = {
    "e1_revenue_trend": f"""
SELECT order_year, CAST(SUM(final_amount_inr) AS DOUBLE) / 1e9 AS rev, COUNT(*) AS orders,
       (CAST(SUM(final_amount_inr) AS DOUBLE) / 1e9 / LAG(CAST(SUM(final_amount_inr) AS DOUBLE) / 1e9)
          OVER (ORDER BY order_year) - 1) * 100 AS yoy
FROM {_F} WHERE {_YW} GROUP BY order_year""",
    "e2_year_month": f"""
SELECT order_year, """ + ", ".join(
        f"COALESCE(CAST(SUM(CASE WHEN order_month = {m} THEN final_amount_inr END) AS DOUBLE) / 1e6, 0.0) AS {n}"
        for m, n in zip(range(1, 13), _MONTHS)) + f"""
FROM {_F} WHERE {_YW} GROUP BY order_year""",
    "e3_rfm_segments": f"""
WITH c0 AS (SELECT customer_id, MAX(order_year * 100 + order_month) AS lp, COUNT(*) AS freq,
                   CAST(SUM(final_amount_inr) AS DOUBLE) AS mon FROM {_F} GROUP BY customer_id),
c AS (SELECT *, MAX(lp) OVER () - lp AS recency FROM c0),
r1 AS ({_qcut('c', 'recency', 'r_s', False)}),
r2 AS ({_qcut('c', 'freq', 'f_s', True)}),
r3 AS ({_qcut('c', 'mon', 'm_s', True)}),
j AS (SELECT r1.customer_id, r1.recency, r1.freq, r1.mon, CAST(r1.r_s AS INTEGER) AS r_s,
             CAST(r2.f_s AS INTEGER) AS f_s, CAST(r3.m_s AS INTEGER) AS m_s
      FROM r1 JOIN r2 ON r1.customer_id = r2.customer_id JOIN r3 ON r1.customer_id = r3.customer_id)
SELECT *, CASE WHEN r_s >= 4 AND f_s >= 4 AND m_s >= 4 THEN 'Champions'
               WHEN r_s >= 3 AND f_s >= 3 AND m_s >= 3 THEN 'Loyal'
               WHEN r_s >= 4 AND f_s <= 2 THEN 'Promising'
               WHEN r_s <= 2 AND f_s >= 3 THEN 'At Risk' ELSE 'Hibernating' END AS segment FROM j""",
    "e4_payment_share": f"""
SELECT order_year, payment_method, COUNT(*) AS n,
       COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY order_year) * 100 AS pct
FROM {_F} WHERE {_YW} GROUP BY order_year, payment_method""",
    "e5_subcategory_perf": f"""
SELECT p.subcategory, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e9 AS rev,
       CAST(SUM(f.final_amount_inr) AS DOUBLE) / CAST(SUM(SUM(f.final_amount_inr)) OVER () AS DOUBLE) * 100
         AS share_pct
FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id GROUP BY p.subcategory""",
    "e5_subcategory_yearly": f"""
WITH s AS (SELECT f.order_year, p.subcategory, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e6 AS rev
           FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id WHERE f.{_YW}
           GROUP BY f.order_year, p.subcategory)
SELECT order_year, subcategory, rev,
       (rev / LAG(rev) OVER (PARTITION BY subcategory ORDER BY order_year) - 1) * 100 AS yoy,
       FIRST_VALUE(order_year) OVER (PARTITION BY subcategory ORDER BY rev DESC, order_year
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS peak_year
FROM s""",
    "e6_prime_impact": f"""
SELECT c.is_prime_member, CAST(SUM(f.final_amount_inr) AS DOUBLE) / COUNT(f.final_amount_inr) AS aov,
       COUNT(*) AS orders, COUNT(DISTINCT f.customer_id) AS custs, COUNT(*) / COUNT(DISTINCT f.customer_id) AS freq
FROM {_F} f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY c.is_prime_member""",
    "e7_top_states": f"""
SELECT c.customer_state, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e9 AS rev
FROM {_F} f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY c.customer_state
ORDER BY rev DESC, c.customer_state LIMIT 15""",
    "e7_tiers": f"""
SELECT c.customer_tier, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e9 AS rev
FROM {_F} f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY c.customer_tier""",
    "e8_festival_split": f"""
SELECT is_festival_sale, CAST(SUM(final_amount_inr) AS DOUBLE) / COUNT(final_amount_inr) AS mean,
       COUNT(final_amount_inr) AS count, CAST(SUM(final_amount_inr) AS DOUBLE) AS sum
FROM {_F} GROUP BY is_festival_sale""",
    "e8_festival_revenue": f"""
SELECT festival_name, CAST(SUM(final_amount_inr) AS DOUBLE) / 1e6 AS rev_m FROM {_F}
WHERE is_festival_sale = TRUE GROUP BY festival_name""",
    "e9_value_by_tier": _box(f"SELECT c.customer_tier, CAST(f.final_amount_inr AS DOUBLE) AS v FROM {_F} f "
                             "JOIN dim_customers c ON f.customer_id = c.customer_id", "customer_tier", "v"),
    "e9_payment_by_tier": f"""
SELECT c.customer_tier, f.payment_method, COUNT(*) AS n,
       COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY c.customer_tier) * 100 AS pct
FROM {_F} f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY c.customer_tier, f.payment_method""",
    "e10_age_subcategory": f"""
SELECT c.customer_age_group, p.subcategory, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e6 AS rev,
       CAST(list_position(['18-25', '26-35', '36-45', '46-55', '55+'], c.customer_age_group) AS INTEGER) AS age_order
FROM {_F} f JOIN dim_customers c ON f.customer_id = c.customer_id JOIN dim_products p ON f.product_id = p.product_id
WHERE list_position(['18-25', '26-35', '36-45', '46-55', '55+'], c.customer_age_group) > 0
GROUP BY c.customer_age_group, p.subcategory""",
    "e11_correlation": f"""
WITH s AS (SELECT ROUND(corr(discounted_price_inr, CAST(discount_percent AS DOUBLE)), 9) AS a,
                  ROUND(corr(discounted_price_inr, CAST(quantity AS DOUBLE)), 9) AS b,
                  ROUND(corr(CAST(discount_percent AS DOUBLE), CAST(quantity AS DOUBLE)), 9) AS c FROM {_F})
SELECT 'discounted_price_inr' AS var_a, 'discount_percent' AS var_b, a AS corr FROM s
UNION ALL SELECT 'discounted_price_inr', 'quantity', b FROM s
UNION ALL SELECT 'discount_percent', 'quantity', c FROM s""",
    "e12_top_brands": f"""
SELECT p.brand, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e9 AS rev,
       CAST(SUM(f.discount_percent) AS DOUBLE) / COUNT(f.discount_percent) AS disc,
       CAST(SUM(f.product_rating) AS DOUBLE) / COUNT(f.product_rating) AS rating
FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id GROUP BY p.brand ORDER BY rev DESC, p.brand LIMIT 15""",
    "e13_returns_subcategory": f"""
SELECT p.subcategory, CAST(SUM(CASE WHEN f.return_status = 'Returned' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100
  AS rate FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id GROUP BY p.subcategory""",
    "e13_returns_payment": f"""
SELECT payment_method, CAST(SUM(CASE WHEN return_status = 'Returned' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100
  AS rate FROM {_F} GROUP BY payment_method""",
    "e14_cohort_retention": f"""
WITH d AS (SELECT DISTINCT customer_id, order_year FROM {_F} WHERE {_YW}),
c AS (SELECT customer_id, MIN(order_year) AS cohort FROM d GROUP BY customer_id),
m AS (SELECT c.cohort, d.order_year, COUNT(*) AS customers FROM d JOIN c ON d.customer_id = c.customer_id
      GROUP BY c.cohort, d.order_year),
z AS (SELECT *, MAX(CASE WHEN order_year = cohort THEN customers END) OVER (PARTITION BY cohort) AS cohort_size FROM m)
SELECT cohort, order_year, customers, customers / cohort_size * 100 AS pct FROM z""",
    "e15_clv_distribution": f"""
WITH c AS (SELECT customer_id, CAST(SUM(final_amount_inr) AS DOUBLE) AS clv FROM {_F} GROUP BY customer_id),
s AS (SELECT quantile_cont(clv, 0.99) AS cap, AVG(clv) AS mean, quantile_cont(clv, 0.5) AS median FROM c),
v AS (SELECT LEAST(c.clv, s.cap) AS v FROM c, s),
mm AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM v),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((v - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin
      FROM v, mm)
SELECT bin, COUNT(*) AS customers, ROUND(s.cap, 4) AS p99_cap, ROUND(s.mean, 4) AS mean_clv,
       ROUND(s.median, 4) AS median_clv FROM b, s GROUP BY bin, s.cap, s.mean, s.median""",
    "e16_delivery_by_type": _box(f"SELECT delivery_type, delivery_days AS v FROM {_F} WHERE delivery_days IS NOT NULL",
                                 "delivery_type", "v"),
    "e16_delivery_by_tier": f"""
SELECT c.customer_tier, AVG(f.delivery_days) AS avg_days
FROM {_F} f JOIN dim_customers c ON f.customer_id = c.customer_id WHERE f.delivery_days IS NOT NULL
GROUP BY c.customer_tier""",
    "e17_discount_bins": f"""
WITH d AS (SELECT *, CASE WHEN discount_percent > 0 AND discount_percent <= 2 THEN '0-2'
                          WHEN discount_percent > 2 AND discount_percent <= 4 THEN '2-4'
                          WHEN discount_percent > 4 AND discount_percent <= 6 THEN '4-6'
                          WHEN discount_percent > 6 AND discount_percent <= 8 THEN '6-8'
                          WHEN discount_percent > 8 AND discount_percent <= 10 THEN '8-10' END AS disc_bin
           FROM {_F} WHERE discount_percent IS NOT NULL)
SELECT disc_bin, CAST(SUM(quantity) AS DOUBLE) / COUNT(quantity) AS avg_quantity,
       CAST(SUM(final_amount_inr) AS DOUBLE) / 1e6 AS rev_m FROM d WHERE disc_bin IS NOT NULL GROUP BY disc_bin""",
    "e18_rating_by_subcategory": _box(f"SELECT p.subcategory, CAST(f.product_rating AS DOUBLE) AS v FROM {_F} f "
                                      "JOIN dim_products p ON f.product_id = p.product_id "
                                      "WHERE f.product_rating IS NOT NULL", "subcategory", "v"),
    "e19_pareto": f"""
WITH p AS (SELECT product_id, SUM(final_amount_inr) AS rev FROM {_F} GROUP BY product_id),
c AS (SELECT CAST(SUM(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
               / CAST(SUM(rev) OVER () AS DOUBLE) * 100 AS cum,
             ROW_NUMBER() OVER (ORDER BY rev DESC, product_id) / COUNT(*) OVER () * 100 AS pp FROM p)
SELECT COALESCE(MAX(CASE WHEN cum <= 80.0 THEN pp END), 100.0) AS top_pct_products, COUNT(*) AS products FROM c""",
    "e21_frequency_buckets": f"""
WITH c AS (SELECT customer_id, COUNT(*) AS n FROM {_F} GROUP BY customer_id)
SELECT CASE WHEN n < 2 THEN '1' WHEN n < 3 THEN '2' WHEN n < 5 THEN '3-4' WHEN n < 10 THEN '5-9'
            WHEN n < 20 THEN '10-19' WHEN n < 50 THEN '20-49' ELSE '50+' END AS bucket,
       COUNT(*) AS customers, SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS one_time FROM c GROUP BY 1""",
    "e21_category_transitions": f"""
WITH r AS (SELECT p.category AS cat, LEAD(p.category) OVER (PARTITION BY f.customer_id
             ORDER BY f.order_date, f.transaction_id, f.line_number, f.product_id, f.supplier_id) AS nxt
           FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id WHERE p.category IS NOT NULL),
g AS (SELECT cat AS from_cat, nxt AS to_cat, COUNT(*) AS transitions FROM r WHERE nxt IS NOT NULL GROUP BY 1, 2)
SELECT *, transitions / SUM(transitions) OVER (PARTITION BY from_cat) * 100 AS pct FROM g""",
    "e22_product_age": f"""
SELECT {AGE_ANCHOR} - p.launch_year AS product_age, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e6 AS rev_m,
       COUNT(*) AS orders
FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id
WHERE p.launch_year BETWEEN {LAUNCH_FIRST} AND {LAUNCH_LAST} GROUP BY 1""",
    "e23_price_percentiles": f"""
SELECT p.subcategory, ROUND(quantile_cont(f.original_price_inr, 0.25), 6) AS p25,
       ROUND(quantile_cont(f.original_price_inr, 0.5), 6) AS median,
       ROUND(quantile_cont(f.original_price_inr, 0.75), 6) AS p75,
       MIN(f.original_price_inr) AS min_p, MAX(f.original_price_inr) AS max_p
FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id
WHERE f.original_price_inr > 0 AND f.original_price_inr < 500000 GROUP BY p.subcategory""",
    "e23_brand_price_boxes": _box(
        f"""SELECT p.brand, f.original_price_inr AS v FROM {_F} f JOIN dim_products p ON f.product_id = p.product_id
WHERE p.brand IN (SELECT brand FROM dim_products WHERE brand IS NOT NULL GROUP BY brand
                  ORDER BY COUNT(*) DESC, brand LIMIT 10)
  AND f.original_price_inr > 0 AND f.original_price_inr < 500000""", "brand", "v", rnd=True),
}

_S = "SUM"
RAW["e22_quadratic_trend"] = f"""
WITH pts AS ({RAW['e22_product_age']}),
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS s0, SUM(CAST(product_age AS DOUBLE)) AS s1,
             SUM(CAST(product_age AS DOUBLE) * product_age) AS s2,
             SUM(CAST(product_age AS DOUBLE) * product_age * product_age) AS s3,
             SUM(CAST(product_age AS DOUBLE) * product_age * product_age * product_age) AS s4,
             SUM(rev_m) AS t0, SUM(CAST(product_age AS DOUBLE) * rev_m) AS t1,
             SUM(CAST(product_age AS DOUBLE) * product_age * rev_m) AS t2 FROM pts),
d AS (SELECT s4 * (s2 * s0 - s1 * s1) - s3 * (s3 * s0 - s1 * s2) + s2 * (s3 * s1 - s2 * s2) AS dd,
             t2 * (s2 * s0 - s1 * s1) - s3 * (t1 * s0 - s1 * t0) + s2 * (t1 * s1 - s2 * t0) AS da,
             s4 * (t1 * s0 - s1 * t0) - t2 * (s3 * s0 - s1 * s2) + s2 * (s3 * t0 - t1 * s2) AS db,
             s4 * (s2 * t0 - t1 * s1) - s3 * (s3 * t0 - t1 * s2) + t2 * (s3 * s1 - s2 * s2) AS dc FROM s)
SELECT ROUND(da / dd, 6) AS a, ROUND(db / dd, 6) AS b, ROUND(dc / dd, 6) AS c FROM d"""

ORACLE = {k: star(v) for k, v in RAW.items()}
