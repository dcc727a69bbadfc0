"""Registry entries for A/B experiments and drift over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import experiments as X
from ..sources.tables import read_table
from .oracle_star import star

WINDOW_DAYS = 7
SPLIT_TS = "2024-01-16 00:00:00"


def _ev(sp, sf):
    return read_table(sp, sf, "events")


def _lab(sp, sf):
    ev = _ev(sp, sf)
    preds = X.prediction_log(ev)
    return X.labelled_predictions(preds, X.materialize_outcomes(preds, ev, WINDOW_DAYS), ev, WINDOW_DAYS)


def _ks(sp, sf):
    ev = _ev(sp, sf)
    split = F.lit(SPLIT_TS).cast("timestamp")
    return X.ks_drift(ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split), "event_type", "value")


SPARK = {
    "x9_ab_assignment": lambda sp, sf: X.assign_version(
        _ev(sp, sf).select(F.col("user_id").alias("customer_id")).distinct(), "customer_id", 0.5)
    .withColumn("bucket", X.ab_bucket(F.col("customer_id"))),
    "x11_ab_outcomes": lambda sp, sf: X.outcomes_to_date(X.prediction_log(_ev(sp, sf)), _ev(sp, sf), WINDOW_DAYS)
    .withColumn("outcome_date", F.col("outcome_date").cast("string")),
    "x12_ab_version_stats": lambda sp, sf: X.version_stats(_lab(sp, sf))
    .withColumn("mean_prob", F.round("mean_prob", 9)).withColumn("churn_rate", F.round("churn_rate", 9)),
    "x13_ab_auc": lambda sp, sf: X.auc_by_group(_lab(sp, sf), "model_version", "churn_prob", "label")
    .withColumn("auc", F.round("auc", 9)),
    "x14_ab_promotion": lambda sp, sf: X.promotion_decision(
        X.version_stats(_lab(sp, sf)), X.auc_by_group(_lab(sp, sf), "model_version", "churn_prob", "label"))
    .withColumn("auc_challenger", F.round("auc_challenger", 9)).withColumn("auc_champion", F.round("auc_champion", 9)),
    "x1_drift_ks": _ks,
    "x2_dataset_drift": lambda sp, sf: X.retrain_decision(X.dataset_drift(_ks(sp, sf))),
}

_BUCKET = "CAST('0x' || right(sha256(CAST({k} AS VARCHAR)), 8) AS BIGINT) % 100"
_PREDS = f"""
preds AS (SELECT user_id AS customer_id, value / 500.0 AS churn_prob, ts AS predicted_at, event_id,
                 CASE WHEN {_BUCKET.format(k='user_id')} < 50 THEN 'challenger' ELSE 'champion' END AS model_version
          FROM events WHERE event_type <> 'purchase'),
nowt AS (SELECT MAX(ts) AS now FROM events),
days AS (SELECT user_id AS customer_id, CAST(ts AS DATE) AS d, ts FROM events WHERE event_type = 'purchase'),
runs AS (SELECT p.customer_id, n.run, n.run_ts, CAST(MIN(p.predicted_at) AS DATE) AS d0
         FROM preds p, (SELECT 1 AS run, now - INTERVAL {WINDOW_DAYS} DAY AS run_ts FROM nowt UNION ALL SELECT 2, now FROM nowt) n
         WHERE p.predicted_at <= n.run_ts - INTERVAL {WINDOW_DAYS} DAY GROUP BY ALL),
labels AS (SELECT r.*, NOT EXISTS (SELECT 1 FROM days x WHERE x.customer_id = r.customer_id AND x.ts <= r.run_ts
                                   AND x.d >= r.d0 AND x.d < r.d0 + {WINDOW_DAYS}) AS churned FROM runs r),
outc AS (SELECT customer_id, churned FROM labels WHERE run = 2),
lab AS (SELECT p.*, CAST(o.churned AS INTEGER) AS label FROM preds p, nowt JOIN outc o ON p.customer_id = o.customer_id
        WHERE p.predicted_at <= now - INTERVAL {WINDOW_DAYS} DAY)"""

_AUC = """
auc AS (SELECT model_version, npos, nneg, (rsum - npos * (npos + 1) / 2.0) / (npos * nneg) AS auc
        FROM (SELECT model_version, SUM(pos * avg_rank) AS rsum, SUM(pos) AS npos, SUM(n) - SUM(pos) AS nneg
              FROM (SELECT *, COALESCE(SUM(n) OVER (PARTITION BY model_version ORDER BY churn_prob
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0 AS avg_rank
                    FROM (SELECT model_version, churn_prob, COUNT(*) AS n, SUM(label) AS pos FROM lab
                          GROUP BY 1, 2) vf) r GROUP BY model_version) g
        WHERE npos > 0 AND nneg > 0)"""

_STATS = """
st AS (SELECT model_version, COUNT(*) AS n, AVG(churn_prob) AS mean_prob, AVG(CAST(label AS DOUBLE)) AS churn_rate
       FROM lab GROUP BY model_version)"""

_KS = f"""
ks0 AS (SELECT event_type, value, SUM(c1) AS c1, SUM(c2) AS c2 FROM (
          SELECT event_type, value, CASE WHEN ts < TIMESTAMP '{SPLIT_TS}' THEN 1 ELSE 0 END AS c1,
                 CASE WHEN ts >= TIMESTAMP '{SPLIT_TS}' THEN 1 ELSE 0 END AS c2 FROM events) t GROUP BY 1, 2),
ks1 AS (SELECT event_type,
               SUM(c1) OVER (PARTITION BY event_type ORDER BY value ROWS UNBOUNDED PRECEDING)
                 / SUM(c1) OVER (PARTITION BY event_type) AS f1,
               SUM(c2) OVER (PARTITION BY event_type ORDER BY value ROWS UNBOUNDED PRECEDING)
                 / SUM(c2) OVER (PARTITION BY event_type) AS f2,
               SUM(c1) OVER (PARTITION BY event_type) AS n1, SUM(c2) OVER (PARTITION BY event_type) AS n2 FROM ks0),
ks2 AS (SELECT event_type, MAX(ABS(f1 - f2)) AS ks_stat, CAST(FIRST(n1) AS BIGINT) AS n_ref,
               CAST(FIRST(n2) AS BIGINT) AS n_cur FROM ks1 GROUP BY event_type),
ks3 AS (SELECT *, (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur)))
                  * ks_stat AS lam FROM ks2),
ks AS (SELECT event_type, ks_stat, n_ref, n_cur,
              CASE WHEN ks_stat = 0 THEN 1.0 ELSE ROUND(LEAST(GREATEST(2 * list_sum(list_transform(range(1, 101),
                   lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 0.0), 1.0), 8) END AS p_value FROM ks3)"""

RAW = {
    "x9_ab_assignment": f"""
SELECT customer_id, CASE WHEN b < 50 THEN 'challenger' ELSE 'champion' END AS model_version, b AS bucket
FROM (SELECT DISTINCT user_id AS customer_id, {_BUCKET.format(k='user_id')} AS b FROM events) t""",
    "x11_ab_outcomes": "WITH " + _PREDS + f"""
SELECT customer_id, churned, CAST(CAST(run_ts AS DATE) AS VARCHAR) AS outcome_date
FROM labels QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY run) = 1""",
    "x12_ab_version_stats": "WITH " + _PREDS + "," + _STATS + """
SELECT model_version, n, ROUND(mean_prob, 9) AS mean_prob, ROUND(churn_rate, 9) AS churn_rate FROM st""",
    "x13_ab_auc": "WITH " + _PREDS + "," + _AUC + """
SELECT model_version, npos, nneg, ROUND(auc, 9) AS auc FROM auc""",
    "x14_ab_promotion": "WITH " + _PREDS + "," + _AUC + "," + _STATS + """
SELECT MAX(CASE WHEN s.model_version = 'challenger' THEN s.n END) AS n_challenger,
       ROUND(MAX(CASE WHEN s.model_version = 'challenger' THEN a.auc END), 9) AS auc_challenger,
       ROUND(MAX(CASE WHEN s.model_version = 'champion' THEN a.auc END), 9) AS auc_champion,
       COALESCE(COALESCE(MAX(CASE WHEN s.model_version = 'challenger' THEN s.n END), 0) >= 1000
         AND MAX(CASE WHEN s.model_version = 'challenger' THEN a.auc END)
             >= MAX(CASE WHEN s.model_version = 'champion' THEN a.auc END) + 0.01, FALSE) AS promote
FROM st s LEFT JOIN auc a ON s.model_version = a.model_version""",
    "x1_drift_ks": "WITH " + _KS + """
SELECT event_type, ks_stat, n_ref, n_cur, p_value, p_value < 0.05 AS drifted FROM ks""",
    "x2_dataset_drift": "WITH " + _KS + """,
d AS (SELECT COUNT(*) AS n_features, SUM(CAST(p_value < 0.05 AS INTEGER)) AS n_drifted FROM ks)
SELECT n_features, n_drifted, n_drifted / n_features AS drift_share, n_drifted / n_features >= 0.5 AS dataset_drift,
       (n_drifted / n_features >= 0.5) AND (n_drifted / n_features >= 0.30) AND n_drifted >= 3 AS retrain FROM d""",
}

ORACLE = dict(RAW)  # events only: no star views needed
