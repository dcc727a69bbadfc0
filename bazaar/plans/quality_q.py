"""Registry entries for the remaining cleaning variants, dirty validation, profiles, JSON, pivots, drift and monitors
(C20, C24, C25, C27, C28, V8, V9, S8, F12, D14, X1, X4, X5, X7, X10, E21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import drift as D
from ..operators import eda
from ..operators import experiments as X
from ..operators import kpis
from ..operators import loading as L
from ..sources.star import in_years, load_star
from ..sources.tables import read_table
from ..streaming import monitors as S
from .experiments_q import _PREDS, SPLIT_TS
from .oracle_star import star

NUMERIC = ["final_amount_inr", "delivery_days", "quantity"]
CATEGORICAL = ["payment_method", "return_status", "delivery_type"]
PROFILED = {"payment_method": "string", "delivery_days": "double", "customer_rating": "decimal(2,1)", "festival_name": "string",
            "return_status": "string", "quantity": "int"}


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


def _ev(sp, sf):
    return read_table(sp, sf, "events")


def _dirty_catalog(sp, sf):
    """Catalog rows in the spellings that the cleaning knows."""
    p = _a(sp, sf).products
    even = F.col("launch_year") % 2 == 0
    return p.select("product_id", F.when(even, " Electronic ").otherwise("electronics & accessories").alias("category"),
                    F.when(F.col("is_prime_eligible"), F.when(even, "Yes").otherwise("1")).otherwise(F.when(even, "no").otherwise("maybe"))
                    .alias("is_prime_eligible"))


def _dirty_fact(sp, sf):
    """Sales rows with texts that are no numbers, methods of no known kind and too long deliveries."""
    f = _a(sp, sf).fact
    return f.select(
        L.line_key().alias("transaction_id"), "customer_id",
        F.when(F.col("delivery_type") == "Same Day", F.lit("on request")).otherwise((F.col("quantity") * 40_000).cast("string")).alias("final_amount_inr"),
        F.when(F.col("quantity") > 45, F.lit("Barter")).otherwise(F.col("payment_method")).alias("payment_method"),
        (F.col("delivery_days") * 2.5).alias("delivery_days"))


def _tiers(sp, sf):
    """Customers whose age group is missing where the balance is low."""
    return _a(sp, sf).customers.select("customer_id", "customer_tier", F.when(
        F.col("customer_spending_tier") != "Low", F.col("customer_age_group")).alias("customer_age_group"))


def _ages(sp, sf):
    a = kpis.age_subcategory(load_star(sp, sf).fact, load_star(sp, sf).customers, load_star(sp, sf).products)
    return eda.age_pivot(a)


def _windows(sp, sf):
    split = F.lit(SPLIT_TS).cast("timestamp")
    e = _ev(sp, sf)
    return D.window_drift(D.window_counts(e.where(F.col("ts") >= split)), e.where(F.col("ts") < split))


def _attributions(sp, sf):
    split = F.lit(SPLIT_TS).cast("timestamp")
    e = _ev(sp, sf).select(F.to_date("ts").cast("string").alias("day"), F.col("event_type").alias("feature"), "value", "ts")
    base = e.where(F.col("ts") < split).groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))
    return D.attribution_drift(e.where(F.col("ts") >= split), base, ["day"])


def _transitions(sp, sf):
    p = _a(sp, sf).products.withColumn("category", F.col("subcategory"))
    return eda.category_transitions_pct(_a(sp, sf).fact, p)


def _quantile(q):
    return lambda sp, sf: S.latency_quantile(S.request_metrics(_ev(sp, sf)), q).withColumn("window_start", F.col("window_start").cast("string"))


SPARK = {
    "c20_clean_products": lambda sp, sf: C.clean_products(_dirty_catalog(sp, sf)),
    "c24_impute_rating": lambda sp, sf: C.impute_rating(_a(sp, sf).fact.select(
        L.line_key().alias("line_key"), "product_id", F.col("customer_rating").cast("double").alias("customer_rating")), "customer_rating"),
    "c25_group_mode": lambda sp, sf: C.fill_group_mode(_tiers(sp, sf), "customer_age_group", "customer_tier", "26-35"),
    "c27_festival_labels": lambda sp, sf: C.festival_labels(_a(sp, sf).fact.select("festival_name")).groupBy(
        "festival_name", "is_festival_sale").agg(F.count(F.lit(1)).alias("n")),
    "c28_before_after": lambda sp, sf: C.before_after(
        _a(sp, sf).fact, _a(sp, sf).fact.where("customer_rating IS NOT NULL").select("payment_method", "customer_rating", "festival_name")),
    "v_validate_dirty": lambda sp, sf: C.validate_sales(_dirty_fact(sp, sf), None, None),
    "v_failure_cases": lambda sp, sf: C.failure_cases(_dirty_fact(sp, sf)),
    "s8_profile_sales": lambda sp, sf: C.profile(_a(sp, sf).fact.select(*PROFILED)).withColumn("null_pct", F.round("null_pct", 9)),
    "f12_props_json": lambda sp, sf: _ev(sp, sf).select("event_type", F.from_json("props", "k int").alias("p")).groupBy("event_type").agg(
        F.count("p.k").alias("n"), F.sum("p.k").alias("total")).withColumn("as_json", F.to_json(F.struct("event_type", "n"))),
    "d14_age_pivot": _ages,
    "x1_column_drift": lambda sp, sf: D.column_drift(
        in_years(_a(sp, sf).fact, 1998, 1998), in_years(_a(sp, sf).fact, 1999, 1999), NUMERIC, CATEGORICAL),
    "x1_distances": lambda sp, sf: D.column_drift(
        in_years(_a(sp, sf).fact, 1998, 1998), in_years(_a(sp, sf).fact, 1999, 1999), NUMERIC, CATEGORICAL, "wasserstein", "jensen_shannon"),
    "x4_window_drift": lambda sp, sf: _windows(sp, sf).withColumns({
        "window_start": F.col("window_start").cast("string"), "distance": F.round("distance", 9)}),
    "x5_attribution_drift": _attributions,
    "x7_latency_p50": _quantile(0.5),
    "x7_latency_p99": _quantile(0.99),
    "x10_prediction_log": lambda sp, sf: X.prediction_log(_ev(sp, sf)).withColumn("predicted_at", F.date_format("predicted_at", "yyyy-MM-dd HH:mm:ss")),
    "e21_subcategory_transitions": _transitions,
}

_PROFILE = """
SELECT '{c}' AS "column", '{t}' AS dtype, COUNT(*) - COUNT({c}) AS nulls, ROUND((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 9) AS null_pct,
       COUNT(DISTINCT {c}) AS n_unique FROM fact_all"""



def _distances() -> str:
    """Wasserstein-1 in deviations of the reference, and Jensen-Shannon, of 1999 against 1998."""
    year = lambda c, y: f"SELECT {c} AS v FROM fact_all WHERE order_year = {y} AND {c} IS NOT NULL"
    parts = []
    for c in NUMERIC:
        d = f"CAST({c} AS DOUBLE)"
        parts.append(f"""
SELECT '{c}' AS feature, 'wasserstein' AS test, d / GREATEST(sd, 0.001) AS stat, n_ref, n_cur FROM (
  SELECT SUM(ABS(fa - fb) * COALESCE(nxt - v, 0)) AS d, MAX(na) AS n_ref, MAX(nb) AS n_cur FROM (
    SELECT v, LEAD(v) OVER o AS nxt, SUM(a) OVER o / SUM(a) OVER () AS fa, SUM(b) OVER o / SUM(b) OVER () AS fb, SUM(a) OVER () AS na, SUM(b) OVER () AS nb
    FROM (SELECT v, SUM(a) AS a, SUM(b) AS b FROM (SELECT v, 1 AS a, 0 AS b FROM ({year(d, 1998)}) x UNION ALL SELECT v, 0, 1 FROM ({year(d, 1999)}) y) u GROUP BY v) g
    WINDOW o AS (ORDER BY v)) w) q, (SELECT stddev_pop(v) AS sd FROM ({year(d, 1998)}) r) s""")
    for c in CATEGORICAL:
        parts.append(f"""
SELECT '{c}' AS feature, 'jensen_shannon' AS test, sqrt(SUM(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) / 2) AS stat,
       MAX(na) AS n_ref, MAX(nb) AS n_cur FROM (
  SELECT a / na AS p, b / nb AS q, (a / na + b / nb) / 2 AS m, na, nb FROM (
    SELECT a, b, SUM(a) OVER () AS na, SUM(b) OVER () AS nb FROM (
      SELECT v, SUM(a) AS a, SUM(b) AS b FROM (SELECT v, 1 AS a, 0 AS b FROM ({year(c, 1998)}) x UNION ALL SELECT v, 0, 1 FROM ({year(c, 1999)}) y) u GROUP BY v) g) t) z""")
    return ("SELECT feature, test, ROUND(stat, 9) AS stat, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, stat >= 0.1 AS drifted FROM ("
            + " UNION ALL ".join(parts) + ") every")


_DIRTY = """
WITH d AS (SELECT concat_ws('-', transaction_id, line_number, product_id, supplier_id) AS transaction_id, customer_id,
                  CASE WHEN delivery_type = 'Same Day' THEN 'on request' ELSE CAST(quantity * 40000 AS VARCHAR) END AS amount,
                  CASE WHEN quantity > 45 THEN 'Barter' ELSE payment_method END AS method, delivery_days * 2.5 AS days FROM fact_all),
v AS (SELECT *, TRY_CAST(amount AS DOUBLE) AS x FROM d)"""
_FAILS = {
    ("final_amount_inr_numeric", "final_amount_inr"): ("x IS NULL", "amount"),
    ("amount_range", "final_amount_inr"): ("x < 1 OR x > 1300000", "amount"),
    ("delivery_range", "delivery_days"): ("days < 0 OR days > 30", "days"),
    ("payment_domain", "payment_method"): ("method = 'Barter'", "method"),
    ("transaction_id_not_null", "transaction_id"): ("transaction_id IS NULL", "transaction_id"),
    ("customer_id_not_null", "customer_id"): ("customer_id IS NULL", "customer_id"),
}

_LE = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]


def _latency(q: float) -> str:
    edges = [0.0, *_LE]
    steps = " ".join(
        f"WHEN le_{i} >= r THEN CAST({edges[i]} AS DOUBLE) + (CAST({edges[i + 1]} AS DOUBLE) - CAST({edges[i]} AS DOUBLE)) * ((r - {lo}) "
        f"/ (CASE WHEN le_{i} > {lo} THEN le_{i} - {lo} ELSE 1 END))" for i in range(10) for lo in [f"le_{i - 1}" if i else "0"])
    sums = ", ".join(f"SUM(CASE WHEN value / 100.0 <= {e} THEN 1 ELSE 0 END) AS le_{i}" for i, e in enumerate(_LE))
    return f"""
WITH m AS (SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
                  CAST({q} AS DOUBLE) * COUNT(*) AS r, {sums} FROM events GROUP BY 1, 2)
SELECT window_start, event_type, ROUND(CASE WHEN le_9 < r THEN 5.0 {steps} END, 9) AS latency_q{int(q * 100)} FROM m"""


def _ks_columns() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, order_year FROM fact_all WHERE {c} IS NOT NULL" for c in NUMERIC)
    cats = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, order_year FROM fact_all WHERE {c} IS NOT NULL" for c in CATEGORICAL)
    return f"""
WITH l AS ({parts}), lc AS ({cats}),
k0 AS (SELECT feature, value, COUNT(*) FILTER (order_year = 1998) AS a, COUNT(*) FILTER (order_year = 1999) AS b FROM l
       WHERE order_year IN (1998, 1999) GROUP BY ALL),
k1 AS (SELECT feature, SUM(a) OVER w / SUM(a) OVER g AS fa, SUM(b) OVER w / SUM(b) OVER g AS fb, SUM(a) OVER g AS na, SUM(b) OVER g AS nb FROM k0
       WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY feature)),
k2 AS (SELECT feature, MAX(ABS(fa - fb)) AS d, MAX(na) AS na, MAX(nb) AS nb FROM k1 GROUP BY feature),
k3 AS (SELECT *, sqrt(na * nb / (na + nb)) AS e FROM k2),
k4 AS (SELECT *, (e + 0.12 + 0.11 / e) * d AS lam FROM k3),
c0 AS (SELECT feature, value, COUNT(*) FILTER (order_year = 1998) AS a, COUNT(*) FILTER (order_year = 1999) AS b FROM lc
       WHERE order_year IN (1998, 1999) GROUP BY ALL),
c1 AS (SELECT *, SUM(a) OVER g AS na, SUM(b) OVER g AS nb, COUNT(*) OVER g AS k FROM c0 WINDOW g AS (PARTITION BY feature)),
c2 AS (SELECT *, (a + b) * na / (na + nb) AS ea, (a + b) * nb / (na + nb) AS eb FROM c1),
c3 AS (SELECT feature, ROUND(SUM((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb), 6) AS stat, MAX(k) - 1 AS dof, MAX(na) AS na, MAX(nb) AS nb
       FROM c2 GROUP BY feature)
SELECT feature, 'ks' AS test, ROUND(d, 9) AS stat, CAST(na AS BIGINT) AS n_ref, CAST(nb AS BIGINT) AS n_cur,
       CASE WHEN d = 0 THEN FALSE ELSE ROUND(LEAST(GREATEST(2 * list_sum(list_transform(range(1, 101),
            lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 0.0), 1.0), 8) < 0.05 END AS drifted FROM k4
UNION ALL SELECT feature, 'chi2', stat, CAST(na AS BIGINT), CAST(nb AS BIGINT),
       COALESCE((pow(stat / dof, 1 / CAST(3 AS DOUBLE)) - (1 - 2 / (9 * CAST(dof AS DOUBLE)))) / sqrt(2 / (9 * CAST(dof AS DOUBLE))) > {D.Z_95}, FALSE)
FROM c3"""


def _window_sql() -> str:
    le = lambda n: ", ".join(f"SUM(CASE WHEN value <= {e} THEN 1 ELSE 0 END) AS {n}_{i}" for i, e in enumerate(D.EDGES))
    gaps = ", ".join(f"ABS(le_{i} / n - ref_{i} / m)" for i in range(len(D.EDGES)))
    return f"""
WITH cur AS (SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS n, {le('le')}
             FROM events WHERE ts >= TIMESTAMP '{SPLIT_TS}' GROUP BY 1, 2),
ref AS (SELECT event_type, COUNT(*) AS m, {le('ref')} FROM events WHERE ts < TIMESTAMP '{SPLIT_TS}' GROUP BY 1)
SELECT window_start, event_type, n, ROUND(GREATEST({gaps}), 9) AS distance, GREATEST({gaps}) > 0.2 AS drifted
FROM cur JOIN ref USING (event_type) WHERE n >= 10"""


ORACLE = {
    "c20_clean_products": star("""
SELECT product_id, CASE WHEN launch_year % 2 = 0 THEN 'Electronics' ELSE 'Electronics' END AS category,
       CASE WHEN is_prime_eligible THEN TRUE WHEN launch_year % 2 = 0 THEN FALSE END AS is_prime_eligible FROM dim_products"""),
    "c24_impute_rating": star("""
WITH r AS (SELECT concat_ws('-', transaction_id, line_number, product_id, supplier_id) AS line_key, product_id,
                  CAST(customer_rating AS DOUBLE) AS x FROM fact_all)
SELECT line_key, product_id, COALESCE(x, quantile_cont(x, 0.5) OVER (PARTITION BY product_id), (SELECT quantile_cont(x, 0.5) FROM r)) AS customer_rating,
       CAST(x IS NULL AS INTEGER) AS rating_missing FROM r"""),
    "c25_group_mode": star("""
WITH t AS (SELECT customer_id, customer_tier, CASE WHEN customer_spending_tier <> 'Low' THEN customer_age_group END AS g FROM dim_customers),
m AS (SELECT customer_tier, g FROM (SELECT customer_tier, g, COUNT(*) AS n FROM t WHERE g IS NOT NULL GROUP BY ALL) c
      QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_tier ORDER BY n DESC, g) = 1)
SELECT t.customer_id, t.customer_tier, COALESCE(t.g, m.g, '26-35') AS customer_age_group FROM t LEFT JOIN m USING (customer_tier)"""),
    "c27_festival_labels": star("""
SELECT COALESCE(festival_name, 'No Festival') AS festival_name, festival_name IS NOT NULL AS is_festival_sale, COUNT(*) AS n
FROM fact_all GROUP BY ALL"""),
    "c28_before_after": star("""
WITH a AS (SELECT COUNT(*) AS b, COUNT(customer_rating) AS k, COUNT(*) FILTER (customer_rating IS NOT NULL AND payment_method IS NULL) AS p,
                  COUNT(*) FILTER (customer_rating IS NOT NULL AND festival_name IS NULL) AS f FROM fact_all)
SELECT UNNEST(['rows_before', 'rows_after', 'rows_removed', 'nulls_payment_method', 'nulls_customer_rating', 'nulls_festival_name']) AS measure,
       UNNEST([b, k, b - k, p, 0, f]) AS value FROM a"""),
    "v_validate_dirty": star(_DIRTY + "\n" + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{c}' AS \"column\", COUNT(*) FILTER ({cond}) AS failures FROM v" for (r, c), (cond, _) in _FAILS.items())
        + "\nUNION ALL SELECT 'transaction_id_unique', 'transaction_id', COUNT(transaction_id) - COUNT(DISTINCT transaction_id) FROM v"),
    "v_failure_cases": star(_DIRTY + "\n" + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{c}' AS \"column\", CAST({val} AS VARCHAR) AS value, COUNT(*) AS n FROM v WHERE {cond} GROUP BY 3"
        for (r, c), (cond, val) in _FAILS.items())),
    "s8_profile_sales": star(" UNION ALL ".join(_PROFILE.format(c=c, t=t) for c, t in PROFILED.items())),
    "f12_props_json": """
SELECT event_type, COUNT(CAST(props->>'k' AS INTEGER)) AS n, CAST(SUM(CAST(props->>'k' AS INTEGER)) AS BIGINT) AS total,
       CAST(to_json({'event_type': event_type, 'n': COUNT(CAST(props->>'k' AS INTEGER))}) AS VARCHAR) AS as_json FROM events GROUP BY event_type""",
    "x1_column_drift": star(_ks_columns()),
    "x1_distances": star(_distances()),
    "x4_window_drift": _window_sql(),
    "x5_attribution_drift": f"""
WITH b AS (SELECT event_type AS feature, AVG(ABS(value)) AS mean_abs FROM events WHERE ts < TIMESTAMP '{SPLIT_TS}' GROUP BY 1),
c AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS feature, AVG(ABS(value)) AS cur FROM events
      WHERE ts >= TIMESTAMP '{SPLIT_TS}' GROUP BY 1, 2),
s AS (SELECT day FROM c GROUP BY day HAVING list_sort(list(feature)) = (SELECT list_sort(list(feature)) FROM b)),
r AS (SELECT day, feature, cur, mean_abs, ABS(cur - mean_abs) / GREATEST(mean_abs, 1e-6) AS ratio FROM c JOIN s USING (day) JOIN b USING (feature))
SELECT day, feature, ROUND(cur, 9) AS current, ROUND(mean_abs, 9) AS baseline, ROUND(ratio, 9) AS drift_ratio, ROUND(ratio, 9) > 0.5 AS alert FROM r""",
    "x7_latency_p95": _latency(0.95),
    "x7_latency_p50": _latency(0.5),
    "x7_latency_p99": _latency(0.99),
    "x10_prediction_log": "WITH " + _PREDS + """
SELECT customer_id, churn_prob, strftime(predicted_at, '%Y-%m-%d %H:%M:%S') AS predicted_at, event_id, model_version FROM preds""",
    "e21_subcategory_transitions": star("""
WITH r AS (SELECT p.subcategory AS a, LEAD(p.subcategory) OVER (PARTITION BY f.customer_id ORDER BY f.order_date, f.transaction_id,
             f.line_number, f.product_id, f.supplier_id) AS b FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id
           WHERE p.subcategory IS NOT NULL)
SELECT a AS from_cat, b AS to_cat, COUNT(*) AS transitions, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY a) * 100 AS pct
FROM r WHERE b IS NOT NULL GROUP BY a, b"""),
    "d14_age_pivot": star("""
WITH t AS (SELECT c.customer_age_group AS g, p.subcategory AS s, CAST(SUM(f.final_amount_inr) AS DOUBLE) / 1e6 AS v
           FROM fact_transactions f JOIN dim_customers c USING (customer_id) JOIN dim_products p USING (product_id) GROUP BY ALL),
o AS (SELECT UNNEST(['18-25', '26-35', '36-45', '46-55', '55+']) AS g, UNNEST([0, 1, 2, 3, 4]) AS age_order)
SELECT g AS customer_age_group, CAST(age_order AS INTEGER) AS age_order, s AS subcategory, COALESCE(v, 0) AS revenue_m FROM t JOIN o USING (g)"""),
}
