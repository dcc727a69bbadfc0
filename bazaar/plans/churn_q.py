"""Registry entries for the churn models (M6-M11, M13, M14, D6, D7) and the mode of a varying column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import churn as C
from ..operators import features as M
from ..session import cut
from ..sources.star import load_star
from .features_q import _AGG
from .oracle_star import star

TRAIN_REF, TEST_REF, WINDOW = "1999-01-01", "2000-01-01", 365
THRESHOLD = 0.8
SHOWN = ["days_since_last_purchase", "total_orders_all_time", "avg_order_value_all_time"]


def _split(sp, sf) -> DataFrame:
    s = load_star(sp, sf, exclude_sentinel=False)
    return C.split(s.fact, s.customers, s.products, TRAIN_REF, TEST_REF, WINDOW, preferred_col="subcategory", rates=(0.0, 1.0))


def _scored(sp, sf) -> DataFrame:
    """Test rows with a plain score, the days since the last purchase as a share, so that SQL can follow."""
    days = F.col("days_since_last_purchase").cast("double")
    return _split(sp, sf).where("split = 'test'").withColumn("score", days / (days + 90.0))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return reduce(lambda d, c: d.withColumn(c, F.round(c, 9)), columns, df)


#: The registered search: fewer trees than the operator's default bounds, as each tree is a row of small Spark jobs.
SETTINGS = C.draw_settings(6, {"trees": (20, 40), "depth": (3, 6), "rate": (0.05, 0.3)})
_FOUND: dict[tuple[str, str], tuple[DataFrame, C.Search]] = {}


def _found(sp, sf) -> tuple[DataFrame, C.Search]:
    """Rows of both dates and the searched model: one model of a session and a folder, for scores and attributions."""
    key = (sp.sparkContext.applicationId, sf)
    if key not in _FOUND:
        rows = cut(_split(sp, sf))
        _FOUND[key] = rows, C.search_model(rows.where("split = 'train'"), SETTINGS, folds=3, first=5)
    return _FOUND[key]


def _model_scores(sp, sf) -> DataFrame:
    rows, found = _found(sp, sf)
    return C.score_rows(found.model, rows.where("split = 'test'"))


def _contributions(sp, sf, of=C.contributions) -> DataFrame:
    rows, found = _found(sp, sf)
    return of(found.model, rows.where("split = 'test'"), "customer_id")


METRICS = ["roc_auc", "avg_precision", "precision", "recall", "f1", "threshold", "churn_rate"]

SPARK = {
    "a6_mode_subcategory": lambda sp, sf: M.customer_aggregates(
        load_star(sp, sf, exclude_sentinel=False).fact, load_star(sp, sf, exclude_sentinel=False).products, TEST_REF,
        preferred_col="subcategory").select("customer_id", "preferred_category"),
    "m6_churn_split": _split,
    "m8_churn_metrics": lambda sp, sf: _rounded(C.metrics(_scored(sp, sf), "score", "churned"), *METRICS),
    "m9_best_threshold": lambda sp, sf: _rounded(C.best_threshold(C.pr_curve(_scored(sp, sf), "score", "churned")), "threshold", "f1"),
    "m10_quality_gate": lambda sp, sf: _rounded(
        C.quality_gate(C.metrics(_scored(sp, sf), "score", "churned")), "roc_auc").select("roc_auc", "meets_threshold"),
    "d6_confusion": lambda sp, sf: _rounded(C.confusion(_scored(sp, sf), "score", "churned", THRESHOLD), "precision", "recall", "f1"),
    "d7_score_histogram": lambda sp, sf: C.score_histogram(_scored(sp, sf), "score", "churned"),
    "d7_features_by_label": lambda sp, sf: reduce(lambda d, c: d.withColumn(c, F.round(c, 6)), ["q1", "median", "q3"],
                                                  C.feature_by_label(_scored(sp, sf), "churned", SHOWN)),
    # the trees themselves have no SQL form: rows only, with tests of their invariants
    "m7_search_trials": lambda sp, sf: _found(sp, sf)[1].trials,
    "m13_churn_scores": _model_scores,
    "m11_mean_attribution": lambda sp, sf: C.mean_attribution(_contributions(sp, sf)),
    "m14_top_contributions": lambda sp, sf: C.top_contributions(_contributions(sp, sf, C.contribution_rows), "customer_id"),
}


def _set(ref: str, tag: str) -> str:
    agg = _AGG.format(ref=ref, join="LEFT").strip()
    agg = f"{tag}_" + agg.replace("COALESCE(MIN(p.category), 'Unknown') AS preferred_category,", "")
    return f"""{agg},
{tag}_pref AS (SELECT customer_id, subcategory FROM (
    SELECT f.customer_id, p.subcategory, COUNT(*) AS n FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id
    WHERE f.order_date < DATE '{ref}' AND p.subcategory IS NOT NULL GROUP BY ALL) c
  QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY n DESC, subcategory) = 1),
{tag} AS (SELECT '{tag}' AS split, a.* EXCLUDE (avg_order_value_last_6m),
    COALESCE(a.avg_order_value_last_6m, a.avg_order_value_all_time) AS avg_order_value_last_6m,
    COALESCE(CAST(c.is_prime_member AS INTEGER), 0) AS is_prime_member, COALESCE(q.subcategory, 'Unknown') AS preferred,
    CASE WHEN EXISTS (SELECT 1 FROM fact_all x WHERE x.customer_id = a.customer_id AND x.order_date >= DATE '{ref}'
                      AND x.order_date < DATE '{ref}' + INTERVAL {WINDOW} DAY) THEN 0 ELSE 1 END AS churned
  FROM {tag}_agg a JOIN dim_customers c ON a.customer_id = c.customer_id LEFT JOIN {tag}_pref q ON q.customer_id = a.customer_id)"""


_BOTH = "WITH " + _set(TRAIN_REF, "train") + ",\n" + _set(TEST_REF, "test")
_SCORED = _BOTH + """,
scored AS (SELECT *, CAST(days_since_last_purchase AS DOUBLE) / (days_since_last_purchase + CAST(90 AS DOUBLE)) AS score FROM test)"""
_CURVE = _SCORED + """,
vf AS (SELECT score, COUNT(*) AS n, SUM(churned) AS pos FROM scored GROUP BY score),
cu AS (SELECT score, n, pos, SUM(n) OVER w AS seen, SUM(pos) OVER w AS hit, SUM(pos) OVER () AS npos, SUM(n) OVER () AS total
       FROM vf WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT *, hit / seen AS precision, hit / npos AS recall FROM cu),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pr),
best AS (SELECT * FROM f ORDER BY f1 DESC, score LIMIT 1),
auc AS (SELECT (SUM(pos * (total - seen + (n + 1) / 2.0)) - MAX(npos) * (MAX(npos) + 1) / 2.0)
               / (MAX(npos) * (MAX(total) - MAX(npos))) AS a, SUM(precision * (pos / npos)) AS ap, MAX(npos) AS npos,
               MAX(total) - MAX(npos) AS nneg FROM f)"""

RAW = {
    "a6_mode_subcategory": _BOTH + "\nSELECT customer_id, preferred AS preferred_category FROM test",
    "m6_churn_split": _BOTH + """,
codes AS (SELECT preferred, ROW_NUMBER() OVER (ORDER BY preferred) - 1 AS code FROM (SELECT DISTINCT preferred FROM train) t)
SELECT u.* EXCLUDE (preferred), CAST(COALESCE(c.code, -1) AS INTEGER) AS preferred_category
FROM (SELECT * FROM train UNION ALL SELECT * FROM test) u LEFT JOIN codes c ON c.preferred = u.preferred""",
    "m8_churn_metrics": _CURVE + """
SELECT ROUND(a, 9) AS roc_auc, ROUND(ap, 9) AS avg_precision, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall,
       ROUND(f1, 9) AS f1, ROUND(score, 9) AS threshold, CAST(auc.npos AS BIGINT) AS npos, CAST(auc.nneg AS BIGINT) AS nneg,
       ROUND(auc.npos / (auc.npos + auc.nneg), 9) AS churn_rate FROM best, auc""",
    "m9_best_threshold": _CURVE + "\nSELECT ROUND(score, 9) AS threshold, ROUND(f1, 9) AS f1 FROM best",
    "m10_quality_gate": _CURVE + "\nSELECT ROUND(a, 9) AS roc_auc, a >= 0.68 AS meets_threshold FROM auc",
    "d6_confusion": _SCORED + f""",
c AS (SELECT COUNT(*) FILTER (score >= {THRESHOLD} AND churned = 1) AS tp, COUNT(*) FILTER (score >= {THRESHOLD} AND churned = 0) AS fp,
             COUNT(*) FILTER (score < {THRESHOLD} AND churned = 1) AS fn, COUNT(*) FILTER (score < {THRESHOLD} AND churned = 0) AS tn FROM scored),
r AS (SELECT *, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS p, COALESCE(tp / NULLIF(tp + fn, 0), 0) AS q FROM c)
SELECT tp, fp, fn, tn, ROUND(p, 9) AS precision, ROUND(q, 9) AS recall,
       ROUND(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END, 9) AS f1 FROM r""",
    "d7_score_histogram": _SCORED + """
SELECT CAST(LEAST(FLOOR(score / (CAST(1 AS DOUBLE) / 40)), 39) AS INTEGER) AS bin, churned, COUNT(*) AS n FROM scored GROUP BY ALL""",
    "d7_features_by_label": _SCORED + "\n" + " UNION ALL ".join(
        f"SELECT churned, '{c}' AS feature, COUNT({c}) AS n, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, "
        f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3 "
        "FROM scored GROUP BY churned" for c in SHOWN),
}

ORACLE = {k: star(v) for k, v in RAW.items()}
