"""Shapley values: against all subsets, additive on all rows; tree arrays against the model; metrics of one-class rows;
drift of columns without values; other odd inputs."""

from itertools import combinations, permutations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.operators import churn as C
from bazaar.operators import drift as D
from bazaar.operators import eda, features
from bazaar.functions import parsers
from bazaar.plans import churn_q
from bazaar.session import cut

from .conftest import SF001


def _by_subsets(score, x, z):
    d = len(x)
    out = np.zeros(d)
    for f in range(d):
        rest = [k for k in range(d) if k != f]
        for n in range(d):
            for s in combinations(rest, n):
                with_f = np.array([x[k] if k in s or k == f else z[k] for k in range(d)])
                without = np.array([x[k] if k in s else z[k] for k in range(d)])
                out[f] += factorial(n) * factorial(d - n - 1) / factorial(d) * (score(with_f[None])[0] - score(without[None])[0])
    return out


def test_all_orders_equal_all_subsets():
    rng = np.random.default_rng(1)
    score = lambda m: m[:, 0] * m[:, 1] + np.where(m[:, 2] > 0, m[:, 3], -m[:, 0]) + m[:, 3] ** 2
    x, z = rng.normal(size=(6, 4)), rng.normal(size=(3, 4))
    got = C.shapley(score, x, z, np.array(list(permutations(range(4)))))
    want = [np.mean([_by_subsets(score, row, b) for b in z], axis=0) for row in x]
    assert np.allclose(got, want)
    few = C.shapley(score, x, z, C.sampled_orders(4, 3))
    assert np.allclose(few.sum(axis=1), score(x) - score(z).mean())


def test_contributions_add_up_on_all_rows(spark):
    rows = cut(churn_q._split(spark, SF001))
    model = C.train_model(rows.where("split = 'train'"), folds=2, depths=(3,), trees=5)
    test = rows.where("split = 'test'")
    raw = model.transform(C._vectors(test)).select("customer_id", C.vector_to_array("rawPrediction")[1].alias("raw"),
                                                   F.array(*[F.col(c).cast("double") for c in C.FEATURES]).alias("x")).collect()
    trees = C.Trees(model)
    assert np.allclose(trees.margins(np.array([r["x"] for r in raw], float)), [r["raw"] for r in raw])
    sums = {r[0]: r[1] for r in C.contributions(model, test, "customer_id").groupBy("customer_id").agg(F.sum("value")).collect()}
    gaps = [r["raw"] - sums[r["customer_id"]] for r in raw]
    assert len(sums) == len(raw) and max(gaps) - min(gaps) < 1e-9  # the background's mean score
    assert C.contributions(model, test.limit(0), "customer_id").count() == 0


@pytest.mark.parametrize("labels", [[0, 0, 0], [1, 1, 1], []])
def test_metrics_with_one_class(spark, labels):
    scored = spark.createDataFrame([(0.1 * i, y) for i, y in enumerate(labels)], "s double, y int")
    m = C.metrics(scored, "s", "y").first()
    assert m["roc_auc"] is None and m["npos"] == sum(labels) and m["nneg"] == len(labels) - sum(labels)
    assert not C.quality_gate(C.metrics(scored, "s", "y")).first()["meets_threshold"]


def test_drift_of_columns_without_values(spark):
    schema = "x double, c string, y double"
    ref = spark.createDataFrame([(float(i), "ab"[i % 2], 1.0) for i in range(20)], schema)
    none = spark.createDataFrame([(None, None, 1.0)] * 5, schema)
    for test, other in (("ks", "chi2"), ("wasserstein", "jensen_shannon")):
        for a, b in ((ref, none), (none, ref)):
            got = {r["feature"]: r for r in D.column_drift(a, b, ["x", "y"], ["c"], test, other).collect()}
            assert got["x"]["stat"] is None and not got["x"]["drifted"]
            assert not got["c"]["drifted"] and got["y"]["stat"] == 0 and not got["y"]["drifted"]


def test_distances(spark):
    ref = spark.createDataFrame([(0.0, "a"), (2.0, "a"), (4.0, "b"), (6.0, "b")], "x double, c string")
    cur = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (5.0, "a"), (7.0, "c")], "x double, c string")
    got = {r["feature"]: r for r in D.column_drift(ref, cur, ["x"], ["c"], "wasserstein", "jensen_shannon").collect()}
    assert abs(got["x"]["stat"] - 1 / np.std([0, 2, 4, 6])) < 1e-8
    p, q = np.array([0.5, 0.5, 0]), np.array([0.75, 0, 0.25])
    m = (p + q) / 2
    kl = lambda a: sum(u * np.log(u / v) for u, v in zip(a, m) if u)
    assert abs(got["c"]["stat"] - np.sqrt((kl(p) + kl(q)) / 2)) < 1e-8


def test_equal_entity_rows_stay(spark):
    e = spark.createDataFrame([("a", "2024-01-10"), ("a", "2024-01-10"), ("b", "2024-01-10")], "k string, d string").withColumn("d", F.col("d").cast("date"))
    f = spark.createDataFrame([("a", "2024-01-05", 7)], "k string, at string, v int").withColumn("at", F.col("at").cast("date"))
    got = features.asof_join(e, f, "k", "d", "at").orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in got] == [("a", 7), ("a", 7), ("b", None)]


def test_pareto_with_products_without_revenue(spark):
    rows = [("a", 90), ("b", 10), ("c", 0), ("d", 0)]
    got = eda.pareto(spark.createDataFrame(rows, "product_id string, final_amount_inr int")).first()
    assert got["top_pct_products"] == 100.0 and got["products"] == 4
    got = eda.pareto(spark.createDataFrame([("a", 40), ("b", 30), ("c", 30), ("d", 0)], "product_id string, final_amount_inr int")).first()
    assert got["top_pct_products"] == 50.0


def test_rating_takes_one_unit_word(spark):
    texts = ["4 stars", "4star", "4 starstars", "4 star stars", "stars"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(parsers.parse_rating("t")).collect()
    assert [r[0] for r in got] == [4.0, 4.0, None, None, None]
