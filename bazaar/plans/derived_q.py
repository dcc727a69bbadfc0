"""Registry entries for the derived dashboard analytics (D-items)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derived as D
from ..operators import kpis
from ..session import stored
from ..sources.star import load_star
from .named import FIRST_YEAR, LAST_YEAR, RAW
from .oracle_star import star


def _q(name, sp, sf):
    from .named import SPARK
    return SPARK[name](sp, sf)


HEALTH_COLUMNS = ["customer_id", "order_date", "order_year", "original_price_inr", "discount_percent", "quantity", "final_amount_inr",
                  "delivery_days", "return_status"]


def _health(sp, sf):
    """The four reports of the scorecard over one stored copy of the columns that they read, so facts are joined once."""
    f = stored(load_star(sp, sf).fact.select(*HEALTH_COLUMNS))
    return D.health_scorecard(kpis.yearly_revenue(f, FIRST_YEAR, LAST_YEAR), kpis.kpi_alert_data(f),
                              kpis.new_customer_growth(f, FIRST_YEAR, LAST_YEAR), kpis.discount_revenue_impact(f, FIRST_YEAR, LAST_YEAR))


SPARK = {
    "d1_alerts": lambda sp, sf: D.alert_evaluation(_q("q_alert", sp, sf)),
    "d2_yoy": lambda sp, sf: D.yearly_growth(_q("q_yearly", sp, sf)),
    "d2_cagr": lambda sp, sf: D.growth_summary(_q("q_yearly", sp, sf)),
    "d3_top_states": lambda sp, sf: D.top_states_from_geo(_q("q_geo", sp, sf), 15),
    "d3_tier_share": lambda sp, sf: D.tier_shares(_q("q_tier", sp, sf)),
    "d4_retention": lambda sp, sf: D.revenue_retention(_q("q_disc", sp, sf)),
    "d5_health": _health,
    "d10_festival_share": lambda sp, sf: D.festival_share_by_year(_q("q_festreg", sp, sf)),
    "d11_seasonality": lambda sp, sf: D.seasonality_summary(_q("q_season", sp, sf)),
    "d12_festival_top": lambda sp, sf: D.festival_top_subcategories(_q("q_festsub", sp, sf), 10),
    "d13_prime_lift": lambda sp, sf: D.prime_lift(_q("q_prime", sp, sf)),
    "d13_prime_share": lambda sp, sf: D.prime_share_by_subcategory(_q("q_primecat", sp, sf)),
    "d15_launch_totals": lambda sp, sf: D.launch_year_totals(_q("q_launch", sp, sf)),
    "d15_launch_mix": lambda sp, sf: D.launch_year_mix(_q("q_launch", sp, sf), 1990, 8),
    "d16_returns": lambda sp, sf: D.return_rate_summary(_q("q_returns", sp, sf)),
    "d17_bands": lambda sp, sf: D.frequency_bands(_q("q_freq", sp, sf)),
    "d17_summary": lambda sp, sf: D.frequency_summary(_q("q_freq", sp, sf)),
    "d18_trans_pct": lambda sp, sf: D.transition_row_pct(_q("q_trans", sp, sf)),
    "d18_top_trans": lambda sp, sf: D.top_transitions(_q("q_trans", sp, sf), 8),
    "d19_flags": lambda sp, sf: D.scorecard_flags(_q("q_score", sp, sf)),
    "d19_best": lambda sp, sf: D.scorecard_best(_q("q_score", sp, sf)),
    "d21_vs_population": lambda sp, sf: D.transaction_vs_population(
        load_star(sp, sf).fact, kpis.anomaly_summary(load_star(sp, sf).fact)),
    "d22_monthly_series": lambda sp, sf: D.monthly_series(_q("q_mrev", sp, sf))
    .withColumn("month_start", F.col("month_start").cast("string")),
}


def _w(name, body):
    return f"WITH {name} AS ({RAW[name.split('__')[0]] if '__' in name else RAW[name]})\n{body}"


RAW_D = {
    "d1_alerts": f"""WITH a AS ({RAW['q_alert']})
SELECT COALESCE(yoy_growth_pct, 0.0) AS yoy_growth_pct, COALESCE(return_rate, 0.0) AS return_rate,
       COALESCE(avg_del, 0.0) AS avg_del,
       COALESCE(yoy_growth_pct, 0.0) < 5 AS yoy_alert, COALESCE(return_rate, 0.0) > 15 AS return_alert,
       COALESCE(avg_del, 0.0) > 7 AS delivery_alert,
       CAST(COALESCE(yoy_growth_pct, 0.0) < 5 AS INTEGER) + CAST(COALESCE(return_rate, 0.0) > 15 AS INTEGER)
         + CAST(COALESCE(avg_del, 0.0) > 7 AS INTEGER) AS n_alerts
FROM a""",
    "d2_yoy": f"""WITH y AS ({RAW['q_yearly']})
SELECT order_year, rev_bn, customers, (rev_bn / LAG(rev_bn) OVER (ORDER BY order_year) - 1) * 100 AS yoy_pct FROM y""",
    "d2_cagr": f"""WITH y AS ({RAW['q_yearly']}),
s AS (SELECT arg_min(rev_bn, order_year) AS first_rev, arg_max(rev_bn, order_year) AS last_rev,
             arg_min(customers, order_year) AS first_cust, arg_max(customers, order_year) AS last_cust,
             COUNT(*) - 1 AS n_years, MAX(customers) AS peak_customers FROM y),
pk AS (SELECT order_year AS peak_revenue_year FROM y ORDER BY rev_bn DESC, order_year LIMIT 1)
SELECT CASE WHEN n_years >= 1 AND first_rev > 0
            THEN ROUND((pow(last_rev / first_rev, 1.0 / n_years) - 1) * 100, 6) ELSE 0.0 END AS revenue_cagr_pct,
       CASE WHEN n_years >= 1 AND first_cust > 0
            THEN ROUND((pow(CAST(last_cust AS DOUBLE) / first_cust, 1.0 / n_years) - 1) * 100, 6) ELSE 0.0 END
         AS customer_cagr_pct,
       peak_revenue_year, peak_customers
FROM s, pk""",
    "d3_top_states": f"""WITH g AS ({RAW['q_geo']})
SELECT customer_state, SUM(rev_m) AS rev_m FROM g GROUP BY customer_state ORDER BY rev_m DESC, customer_state LIMIT 15""",
    "d3_tier_share": f"""WITH t AS ({RAW['q_tier']})
SELECT customer_tier, revenue_m / SUM(revenue_m) OVER () * 100 AS revenue_share_pct,
       customers / SUM(customers) OVER () * 100 AS customer_share_pct FROM t""",
    "d4_retention": f"""WITH d AS ({RAW['q_disc']})
SELECT order_year, net_rev / gross_rev * 100 AS net_margin_pct,
       SUM(gross_rev) OVER () / 1e9 AS total_gross_bn, SUM(net_rev) OVER () / 1e9 AS total_net_bn,
       SUM(discount_given) OVER () / 1e9 AS total_discount_bn,
       SUM(net_rev) OVER () / SUM(gross_rev) OVER () * 100 AS avg_retention_pct,
       SUM(discount_given) OVER () / SUM(gross_rev) OVER () * 100 AS discount_pct_of_gross
FROM d""",
    "d5_health": f"""WITH y AS ({RAW['q_yearly']}), a AS ({RAW['q_alert']}), n AS ({RAW['q_newcust']}),
d AS ({RAW['q_disc']}),
yy AS (SELECT order_year, (rev_bn / LAG(rev_bn) OVER (ORDER BY order_year) - 1) * 100 AS v FROM y),
g AS (SELECT v FROM yy WHERE v IS NOT NULL ORDER BY order_year DESC LIMIT 1),
n2 AS (SELECT new_customers, ROW_NUMBER() OVER (ORDER BY cohort_year DESC) AS rn FROM n),
acq AS (SELECT MAX(CASE WHEN rn = 1 THEN new_customers END) AS last, MAX(CASE WHEN rn = 2 THEN new_customers END) AS prev,
               COUNT(*) AS cnt FROM n2 WHERE rn <= 2),
dd AS (SELECT avg_discount_pct AS v FROM d ORDER BY order_year DESC LIMIT 1)
SELECT 'revenue_growth' AS item, v AS value, CASE WHEN v >= 5 THEN 'green' WHEN v >= 0 THEN 'amber' ELSE 'red' END AS status FROM g
UNION ALL SELECT 'return_rate', COALESCE(return_rate, 0.0),
  CASE WHEN COALESCE(return_rate, 0.0) < 10 THEN 'green' WHEN COALESCE(return_rate, 0.0) < 15 THEN 'amber' ELSE 'red' END FROM a
UNION ALL SELECT 'avg_delivery', COALESCE(avg_del, 0.0),
  CASE WHEN COALESCE(avg_del, 0.0) <= 5 THEN 'green' WHEN COALESCE(avg_del, 0.0) <= 7 THEN 'amber' ELSE 'red' END FROM a
UNION ALL SELECT 'avg_order_value', COALESCE(aov, 0.0), 'green' FROM a
UNION ALL SELECT 'customer_acquisition', CAST(last - COALESCE(prev, 0) AS DOUBLE),
  CASE WHEN cnt = 2 AND last > prev THEN 'green' ELSE 'amber' END FROM acq WHERE cnt > 0
UNION ALL SELECT 'discount_strategy', v, CASE WHEN v < 20 THEN 'green' WHEN v < 30 THEN 'amber' ELSE 'red' END FROM dd""",
    "d10_festival_share": f"""WITH f AS ({RAW['q_festreg']})
SELECT order_year, festival_rev_m / (festival_rev_m + regular_rev_m) * 100 AS festival_pct FROM f""",
    "d11_seasonality": f"""WITH s AS ({RAW['q_season']}),
n AS (SELECT order_month, avg_rev_m, strftime(make_date(2000, order_month, 1), '%b') AS month_name FROM s)
SELECT (SELECT month_name FROM n ORDER BY avg_rev_m DESC, month_name LIMIT 1) AS peak_month,
       (SELECT month_name FROM n ORDER BY avg_rev_m ASC, month_name LIMIT 1) AS low_month,
       (SELECT SUM(CASE WHEN order_month IN (10, 11, 12) THEN avg_rev_m ELSE 0.0 END) / SUM(avg_rev_m) * 100 FROM n)
         AS q4_share_pct""",
    "d12_festival_top": f"""WITH f AS ({RAW['q_festsub']}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY festival_name ORDER BY revenue_m DESC, subcategory) AS rank FROM f)
SELECT * FROM r WHERE rank <= 10""",
    "d13_prime_lift": f"""WITH p AS ({RAW['q_prime']}),
s AS (SELECT COALESCE(MAX(CASE WHEN is_prime_member THEN avg_order_value END), 0.0) AS prime_aov,
             COALESCE(MAX(CASE WHEN NOT is_prime_member THEN avg_order_value END), 0.0) AS non_prime_aov,
             COALESCE(MAX(CASE WHEN is_prime_member THEN revenue_m END), 0.0) AS prime_rev,
             SUM(revenue_m) AS total_rev,
             COALESCE(MAX(CASE WHEN is_prime_member THEN avg_discount END), 0.0) AS prime_disc,
             COALESCE(MAX(CASE WHEN NOT is_prime_member THEN avg_discount END), 0.0) AS non_prime_disc FROM p)
SELECT prime_aov, non_prime_aov, (prime_aov / GREATEST(non_prime_aov, 1.0) - 1) * 100 AS aov_lift_pct,
       prime_rev / total_rev * 100 AS prime_revenue_share_pct, prime_disc - non_prime_disc AS discount_delta FROM s""",
    "d13_prime_share": f"""WITH p AS ({RAW['q_primecat']})
SELECT subcategory, SUM(CASE WHEN is_prime_member THEN revenue_m ELSE 0.0 END) / SUM(revenue_m) * 100 AS prime_share_pct
FROM p GROUP BY subcategory""",
    "d15_launch_totals": f"""WITH l AS ({RAW['q_launch']})
SELECT launch_year, SUM(revenue_m) AS revenue_m, SUM(products) AS products FROM l GROUP BY launch_year""",
    "d15_launch_mix": f"""WITH l AS ({RAW['q_launch']})
SELECT subcategory, revenue_m FROM l WHERE launch_year = 1990 ORDER BY revenue_m DESC, subcategory LIMIT 8""",
    "d16_returns": f"""WITH r AS ({RAW['q_returns']})
SELECT AVG(return_rate) AS avg_return_rate,
       (SELECT subcategory FROM r ORDER BY return_rate DESC, subcategory LIMIT 1) AS worst_subcategory,
       MAX(return_rate) AS worst_rate,
       (SELECT subcategory FROM r ORDER BY return_rate ASC, subcategory LIMIT 1) AS best_subcategory,
       MIN(return_rate) AS best_rate FROM r""",
    "d17_bands": f"""WITH f AS ({RAW['q_freq']}),
b AS (SELECT * FROM (VALUES ('1 order', 0), ('2 orders', 1), ('3-5 orders', 2), ('6-10 orders', 3),
                            ('11-20 orders', 4), ('21+ orders', 5)) t(bucket, band_order)),
g AS (SELECT CASE WHEN order_count = 1 THEN '1 order' WHEN order_count = 2 THEN '2 orders'
                  WHEN order_count <= 5 THEN '3-5 orders' WHEN order_count <= 10 THEN '6-10 orders'
                  WHEN order_count <= 20 THEN '11-20 orders' ELSE '21+ orders' END AS bucket,
             SUM(customers) AS customers FROM f GROUP BY 1),
j AS (SELECT b.bucket, CAST(b.band_order AS INTEGER) AS band_order, CAST(COALESCE(g.customers, 0) AS BIGINT) AS customers
      FROM b LEFT JOIN g ON b.bucket = g.bucket)
SELECT bucket, band_order, customers, customers / SUM(customers) OVER () * 100 AS pct FROM j""",
    "d17_summary": f"""WITH f AS ({RAW['q_freq']}),
s AS (SELECT SUM(customers) AS t, SUM(CASE WHEN order_count = 1 THEN customers ELSE 0 END) AS one,
             SUM(CASE WHEN order_count >= 11 THEN customers ELSE 0 END) AS loyal FROM f)
SELECT one / t * 100 AS one_time_pct, 100 - one / t * 100 AS repeat_pct, loyal / t * 100 AS loyal_pct FROM s""",
    "d18_trans_pct": f"""WITH t AS ({RAW['q_trans']})
SELECT from_cat, to_cat, transitions / SUM(transitions) OVER (PARTITION BY from_cat) * 100 AS pct FROM t""",
    "d18_top_trans": f"""WITH t AS ({RAW['q_trans']})
SELECT * FROM t ORDER BY transitions DESC, from_cat, to_cat LIMIT 8""",
    "d19_flags": f"""WITH s AS ({RAW['q_score']})
SELECT subcategory, revenue_m < quantile_cont(revenue_m, 0.5) OVER () AS below_median_revenue,
       COALESCE(avg_rating, 0.0) < 3.5 AS low_rating, COALESCE(return_rate, 0.0) > 10 AS high_return FROM s""",
    "d19_best": f"""WITH s AS ({RAW['q_score']})
SELECT (SELECT subcategory FROM s ORDER BY revenue_m DESC, subcategory LIMIT 1) AS best_performing,
       (SELECT subcategory FROM s ORDER BY avg_rating DESC, subcategory LIMIT 1) AS highest_rated,
       (SELECT subcategory FROM s ORDER BY return_rate ASC, subcategory LIMIT 1) AS lowest_return_rate""",
    "d21_vs_population": f"""WITH a AS ({RAW['q_anomsum']})
SELECT f.transaction_id, f.line_number, f.product_id, f.supplier_id,
       CAST(f.discount_percent AS DOUBLE) - a.avg_discount_pct AS discount_vs_mean,
       CAST(f.discount_percent AS DOUBLE) > a.p95_discount_pct AS discount_above_p95,
       f.delivery_days - a.avg_delivery_days AS delivery_vs_mean,
       f.delivery_days > a.p95_delivery_days AS delivery_above_p95
FROM fact_transactions f, a""",
    "d22_monthly_series": f"""WITH m AS ({RAW['q_mrev']})
SELECT CAST(make_date(order_year, order_month, 1) AS VARCHAR) AS month_start, revenue, orders FROM m
WHERE order_year != 1900 ORDER BY month_start""",
}

ORACLE = {k: star(v) for k, v in RAW_D.items()}
