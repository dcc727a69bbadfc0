"""Registry entries for the model jobs (forecast M15-M17, D20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecasting as FC
from ..sources.star import load_star
from .oracle_star import star


def _a(sp, sf):
    return load_star(sp, sf, exclude_sentinel=False)


def _series(sp, sf):
    return FC.monthly_series(_a(sp, sf).fact, _a(sp, sf).products)


SPARK = {
    "m15_monthly_series": lambda sp, sf: _series(sp, sf).withColumn("month", F.col("month").cast("string")),
    # model outputs: rows-only checks (value parity with the reference's solver is not expected)
    "m16_forecast": lambda sp, sf: FC.forecast(_series(sp, sf)),
    "m16_trend_changes": lambda sp, sf: FC.trend_changes(_series(sp, sf)),
    "m17_model_comparison": lambda sp, sf: FC.compare_models(_series(sp, sf)),
    "m17_wmape": lambda sp, sf: FC.wmape(FC.forecast(_series(sp, sf))),
    "d20_next_month_forecast": lambda sp, sf: FC.next_month_summary(FC.forecast(_series(sp, sf))),
}

ORACLE = {
    "m15_monthly_series": star("""
SELECT CAST(CAST(date_trunc('month', f.order_date) AS DATE) AS VARCHAR) AS month, p.subcategory,
       CAST(SUM(f.final_amount_inr) AS DOUBLE) AS total_revenue
FROM fact_all f JOIN dim_products p ON f.product_id = p.product_id
WHERE f.order_date IS NOT NULL AND p.subcategory IS NOT NULL GROUP BY 1, 2"""),
}
