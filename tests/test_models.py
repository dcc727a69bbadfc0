"""Invariants of the trained models: churn trees, demand trees, isolation forest, attributions, gates."""

import pytest
from pyspark.sql import functions as F

from bazaar.operators import anomaly as A
from bazaar.operators import churn as C
from bazaar.operators import pricing as P
from bazaar.operators.forecasting import forecast, next_month_summary
from bazaar.plans import churn_q, pricing_q
from bazaar.session import cut

from .conftest import SF001


@pytest.fixture(scope="module")
def rows(spark):
    return cut(churn_q._split(spark, SF001))


@pytest.fixture(scope="module")
def model(rows):
    return C.train_model(rows.where("split = 'train'"), folds=2, depths=(3,), trees=5)


def test_scores_rank_better_than_chance(rows, model):
    test = rows.where("split = 'test'")
    scored = C.score_rows(model, test, 0.4)
    m = C.metrics(scored, "churn_probability", "churned").first()
    assert m["roc_auc"] > 0.5 and 0 < m["avg_precision"] <= 1
    assert scored.count() == test.count()
    assert scored.where("churn_label != CAST(churn_probability >= 0.4 AS INT)").count() == 0


def test_gate_refuses(rows, model):
    row = C.metrics(C.score_rows(model, rows.where("split = 'test'")), "churn_probability", "churned")
    C.require_quality(C.quality_gate(row, least=0.0))
    with pytest.raises(RuntimeError):
        C.require_quality(C.quality_gate(row, least=1.1))


def test_rate_bounds(spark):
    from bazaar.sources.star import load_star

    s = load_star(spark, SF001, exclude_sentinel=False)
    with pytest.raises(ValueError):
        C.split(s.fact, s.customers, s.products, "1999-01-01", "2000-01-01", rates=(0.999, 1.0))


def test_unknown_category_is_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    codes = C.ordinal_codes(train, "c")
    got = C.encode(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string"), "c", codes)
    assert sorted(r["c"] for r in got.collect()) == [-1, -1, 0, 1]


def test_attributions_cover_all_rows(rows, model):
    test = rows.where("split = 'test'")
    c = cut(C.contributions(model, test, "customer_id"))
    n = test.count()
    assert c.count() == n * len(C.FEATURES)
    mean = C.mean_attribution(c).collect()
    assert len(mean) == len(C.FEATURES) and all(r["n"] == n and r["mean_abs"] >= 0 for r in mean)
    top = C.top_contributions(c, "customer_id", 3).first()["top"]
    assert len(top) == 3 and [abs(t["value"]) for t in top] == sorted((abs(t["value"]) for t in top), reverse=True)


def test_threshold_ties_go_to_the_lowest(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.4, 1)], "s double, y int")
    best = C.best_threshold(C.pr_curve(scored, "s", "y")).first()
    assert best["threshold"] == 0.4 and abs(best["f1"] - 0.8) < 1e-6


def test_demand_trees_and_scenarios(spark):
    rows = cut(P.temporal_split(pricing_q._features(spark, SF001)))
    model = P.train_demand(rows.where("NOT is_test"), trees=5)
    q = P.fit_quality(model, rows.where("is_test")).first()
    assert q["rmse"] >= 0 and q["months"] > 0
    prices = rows.groupBy("subcategory", "subcategory_encoded").agg(F.avg("avg_price_inr").alias("price"))
    got = P.model_scenarios(model, prices, 10)
    assert got.count() == 5 * prices.count() and {r[0] for r in got.select("delta_pct").distinct().collect()} == set(P.DELTAS)
    assert P.best_scenario(got).where("gain < 0").count() == 0


def test_isolation_forest_flags_what_stands_out(spark):
    rows = [(str(i), 100.0 + i % 7, 0.1, float(i % 5), 0.0) for i in range(2000)] + [("far", 9000.0, 0.9, 30.0, 1.0)]
    frame = cut(spark.createDataFrame(rows, "k string, final_amount_inr double, discount_pct double, delivery_days double, is_return double"))
    frame = cut(A.scaled(frame, A.scaling(frame)))
    forest = cut(A.grow_forest(frame, "k", trees=50))
    assert forest.select("tree").distinct().count() == 50 and forest.groupBy("tree").agg(F.max("size").alias("n")).where("n > 256").count() == 0
    got = cut(A.flag(A.score_samples(frame, forest)))
    assert got.count() == 2001 and got.orderBy("anomaly_score").first()["k"] == "far"
    assert got.where("is_anomaly").count() <= 0.05 * 2001


def test_rows_to_score_may_lack_values(spark):
    rows = spark.createDataFrame([(None, 0.0, None, True), (80.0, 100.0, 2.0, False)],
                                 "final_amount_inr double, mrp_inr double, delivery_days double, is_returned boolean")
    got = A.with_discount(rows).select(*A.FEATURES).collect()
    assert [tuple(round(v, 6) for v in r) for r in got] == [(0.0, 0.0, 0.0, 1.0), (80.0, 0.2, 2.0, 0.0)]


def test_forecast_months(spark):
    rows = [(f"{2018 + i // 12}-{i % 12 + 1:02d}-01", "S", 100.0 + i) for i in range(24)]
    series = spark.createDataFrame(rows, "month string, subcategory string, total_revenue double").withColumn("month", F.col("month").cast("date"))
    held = forecast(series, horizon=12, holdout=3)
    assert held.where("kind = 'forecast'").count() == 12 and held.where("kind = 'holdout'").count() == 3
    assert str(next_month_summary(held).first()["ds"]) == "2019-10-01"
    full = forecast(series, horizon=12, holdout=3, refit_full=True)
    assert full.where("kind = 'forecast'").count() == 12 and str(next_month_summary(full).first()["ds"]) == "2020-01-01"
