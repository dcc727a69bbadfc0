"""Registry entries for the monitoring aggregates (batch form of the streaming jobs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.drift import EDGES
from ..sources.tables import read_table
from ..streaming import buffers as B
from ..streaming import monitors as S

SPLIT_TS = "2024-01-16 00:00:00"
EVERY = 100
MEANS = {"value": 0.1, "hour": 0.4}  # baseline of the attribution monitor


def _buffer_drift(sp, sf):
    e = read_table(sp, sf, "events")
    split = F.lit(SPLIT_TS).cast("timestamp")
    vector = B.drift_vector(["value"], EDGES)
    got = B.flushes(e.where(F.col("ts") >= split), "event_type", "event_id", vector, len(EDGES) + 1, EVERY)
    return B.buffer_drift(got, "event_type", e.where(F.col("ts") < split), ["value"], EDGES).withColumn("distance", F.round("distance", 9))


def _buffer_attributions(sp, sf):
    e = read_table(sp, sf, "events").select("event_type", "event_id", F.create_map(
        F.lit("value"), F.col("value") / 500.0, F.lit("hour"), F.hour("ts") / 24.0).alias("c"))
    got = B.flushes(e, "event_type", "event_id", B.attribution_vector("c", list(MEANS)), 1 + len(MEANS), EVERY)
    return B.buffer_attribution_drift(got, "event_type", MEANS).withColumns({c: F.round(c, 9) for c in ("current", "drift_ratio")})


SPARK = {
    "x6_request_metrics": lambda sp, sf: S.request_metrics(read_table(sp, sf, "events"))
    .withColumn("window_start", S.F.col("window_start").cast("string")),
    "x7_latency_p95": lambda sp, sf: S.latency_quantile(S.request_metrics(read_table(sp, sf, "events")), 0.95)
    .withColumn("window_start", S.F.col("window_start").cast("string")),
    "x8_score_histogram": lambda sp, sf: S.score_histogram(read_table(sp, sf, "events"))
    .withColumn("window_start", S.F.col("window_start").cast("string")),
    "x4_buffer_drift": _buffer_drift,
    "x5_buffer_attributions": _buffer_attributions,
}

_LE = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
_SE = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]

ORACLE = {
    "x6_request_metrics": """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       COUNT(*) AS requests, SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors,
       SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) / COUNT(*) AS error_ratio,
       SUM(value / 100.0) / COUNT(*) AS mean_latency, """ + ", ".join(
        f"SUM(CASE WHEN value / 100.0 <= {e} THEN 1 ELSE 0 END) AS le_{i}" for i, e in enumerate(_LE)) + """
FROM events GROUP BY 1, 2""",
    "x8_score_histogram": """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS n,
       SUM(value / 500.0) / COUNT(*) AS mean_score,
       1 - SUM(CASE WHEN value / 500.0 <= 0.5 THEN 1 ELSE 0 END) / COUNT(*) AS share_above_half, """ + ", ".join(
        f"SUM(CASE WHEN value / 500.0 <= {e} THEN 1 ELSE 0 END) AS le_{i}" for i, e in enumerate(_SE)) + """
FROM events WHERE event_type <> 'purchase' GROUP BY 1""",
    "x4_buffer_drift": f"""
WITH r AS (SELECT event_type, event_id, value, (ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {EVERY} AS flush
           FROM events WHERE ts >= TIMESTAMP '{SPLIT_TS}'),
b AS (SELECT {", ".join(f"AVG(CAST(value <= {x} AS INTEGER)) AS b{i}" for i, x in enumerate(EDGES))} FROM events WHERE ts < TIMESTAMP '{SPLIT_TS}'),
g AS (SELECT event_type, flush, COUNT(*) AS n, {", ".join(f"AVG(CAST(value <= {x} AS INTEGER)) AS g{i}" for i, x in enumerate(EDGES))}
      FROM r GROUP BY ALL HAVING COUNT(*) = {EVERY}),
d AS (SELECT event_type, flush, n, GREATEST({", ".join(f"ABS(g{i} - b{i})" for i in range(len(EDGES)))}) AS distance FROM g, b)
SELECT event_type, flush, n, 'value' AS feature, ROUND(distance, 9) AS distance, distance > 0.2 AS drifted FROM d""",
    "x5_buffer_attributions": f"""
WITH r AS (SELECT event_type, value, ts, (ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {EVERY} AS flush FROM events),
g AS (SELECT event_type, flush, COUNT(*) AS n, AVG(ABS(value / 500.0)) AS value, AVG(hour(ts) / 24.0) AS hour FROM r GROUP BY ALL HAVING COUNT(*) = {EVERY}),
u AS (""" + " UNION ALL ".join(f"SELECT event_type, flush, n, '{f}' AS feature, {f} AS current, CAST({m} AS DOUBLE) AS baseline FROM g" for f, m in MEANS.items()) + """)
SELECT event_type, flush, n, feature, ROUND(current, 9) AS current, baseline, ROUND(ABS(current - baseline) / baseline, 9) AS drift_ratio,
       ABS(current - baseline) / baseline > 0.5 AS alert FROM u""",
}
