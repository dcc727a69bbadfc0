"""Search over seven parameters: bounds, halving, the chosen setting, folds of one class."""

import pytest
from pyspark.sql import functions as F

from bazaar.operators import churn as C

SMALL = {"trees": (2, 6), "depth": (2, 3), "rate": (0.1, 0.3), "least_rows": (1, 5)}


def _frame(spark, n, label):
    rows = spark.range(n).withColumnRenamed("id", "customer_id")
    for k, f in enumerate(C.FEATURES):
        rows = rows.withColumn(f, F.pmod(F.xxhash64(F.lit(k), "customer_id"), F.lit(100)).cast("double"))
    return rows.withColumn("churned", F.expr(label).cast("int"))


def test_settings_lie_in_their_bounds():
    got = C.draw_settings(200)
    assert got == C.draw_settings(200) and got != C.draw_settings(200, seed=1)
    for name, (low, high) in C.BOUNDS.items():
        values = [getattr(s, name) for s in got]
        assert low <= min(values) and max(values) <= high and len(set(values)) > 3
    assert sum(s.rate < 0.055 for s in got) > 70  # a log scale


def test_search_halves_and_chooses(spark):
    rows = _frame(spark, 300, f"{C.NUMERIC[1]} > 50")
    blind = C.Setting(4, 2, 0.1, 1.0, 1.0, 0.0, 299)  # no split leaves so many rows on a side
    settings = [blind, *C.draw_settings(2, SMALL)]
    found = C.search_model(rows, settings, folds=2, first=2)
    trials = found.trials.collect()
    assert [sum(t["rung"] == k for t in trials) for k in (0, 1)] == [3, 2] and max(t["rung"] for t in trials) == 1
    assert all(t["trees_used"] == min(t["trees"], 2 << t["rung"]) and len(t["fold_auc"]) == 2 for t in trials)
    by = {(t["trial"], t["rung"]): t for t in trials}
    assert by[0, 0]["mean_auc"] == 0.5 and found.setting != blind
    assert {t["trial"] for t in trials if t["chosen"]} == {settings.index(found.setting)}
    assert found.model.getNumTrees == found.setting.trees
    auc = C.metrics(C.score_rows(found.model, _frame(spark, 400, f"{C.NUMERIC[1]} > 50").where("customer_id >= 300")), "churn_probability", "churned")
    assert auc.first()["roc_auc"] > 0.95


def test_one_class_has_no_auc(spark):
    found = C.search_model(_frame(spark, 60, "true"), C.draw_settings(2, SMALL), folds=2, first=2)
    assert all(t["mean_auc"] is None and t["fold_auc"] == [None, None] for t in found.trials.collect())
    assert found.setting == C.draw_settings(2, SMALL)[0]
    with pytest.raises(ValueError):
        C.search_model(_frame(spark, 5, "true"), [])
