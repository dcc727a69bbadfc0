"""Buckets that the penalty leaves without a weight whatever the labels are: not fitted, and the model is the same."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from bazaar.llm import mixing

N = 3000  # 0.0018 x 3000 documents are 5.4, so 5 documents earn no weight and 6 may


@pytest.fixture()
def rows(spark):
    """Buckets 0 to 2 tell the domains, if not always; 100 to 299 are held by 5 documents each, 300 to 349 by 6 of one domain."""
    told = F.when(F.col("id") % 7 == 0, (F.col("id") + 1) % 3).otherwise(F.col("id") % 3)
    few = F.when(F.col("id") < 1000, 100 + F.col("id") % 200)
    more = F.when((F.col("id") >= 1000) & (F.col("id") < 1900) & (F.col("id") % 3 == 1), 300 + F.floor(F.col("id") / 3) % 50)
    return spark.range(0, N, 1, 3).select(
        F.element_at(F.array(*map(F.lit, ["good", "low", "toxic"])), (F.col("id") % 3 + 1).cast("int")).alias("domain"),
        F.array_compact(F.array(told, few, more)).cast("array<int>").alias("_b"))


def test_buckets_no_weight_is_worth_are_not_fitted(rows, monkeypatch):
    sizes, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, x, *a: sizes.append(x.first()["_x"].size) or fit(self, x, *a))
    model = mixing._fitted(rows)
    assert mixing._told(rows, N) == [0, 1, 2, *range(300, 350)] and sizes == [53]
    monkeypatch.setattr(mixing, "_told", lambda rows, n: [0, 1, 2, *range(100, 350)])
    whole = mixing._fitted(rows)  # with all of them
    assert sizes == [53, 253] and not whole.weights[:, 100:300].any() and whole.weights[:, :3].any()
    assert np.abs(model.weights - whole.weights).max() < 0.01 and np.abs(model.intercepts - whole.intercepts).max() < 0.01


def test_the_bound_holds_for_any_labels(rows):
    """A bucket at the bound, all of whose documents are of one domain, is fitted where one document more holds it."""
    one = rows.withColumn("_b", F.concat("_b", F.when(F.col("domain") == "toxic", F.array(F.lit(400))).otherwise(F.array().cast("array<int>"))))
    assert 400 in mixing._told(one, N)
    assert mixing._told(rows.limit(0), 1) == []
