"""The factorization machine: plain formula, interactions, held-out accuracy, odd tables."""

import zlib

import numpy as np
import pytest

from bazaar.llm import queries, toxicity
from bazaar.llm.common import documents

SF = "/root/testdata/sf0.01"


def test_margin_is_bias_weights_and_all_pairs():
    rng = np.random.default_rng(3)
    m = toxicity.Machine(0.3, rng.normal(size=toxicity.BUCKETS), rng.normal(size=(toxicity.BUCKETS, toxicity.FACTORS)))
    rows = [np.array(sorted(rng.choice(toxicity.BUCKETS, n, replace=False)), np.int64) for n in (0, 1, 2, 7, 0, 40)]
    for row, got in zip(rows, m.margins(rows)):
        want = 0.3 + sum(m.weights[i] for i in row)
        want += sum(m.factors[a] @ m.factors[b] for k, a in enumerate(row) for b in row[k + 1:])
        assert abs(got - want) < 1e-8


def _talk(rng, insult, group):
    words = [f"w{k}" for k in rng.integers(0, 400, 40)] + ["zounk"] * insult + ["grolk"] * group
    return " ".join(rng.permutation(words))


def test_interaction_that_no_linear_weights_tell(spark):
    """Toxic if exactly one of two words is there: any linear weights err on a fourth of the kinds at least."""
    rng = np.random.default_rng(0)
    rows, tags = [], []
    for i in range(5000):
        a, b = int(rng.random() < 0.4), int(rng.random() < 0.4)
        rows.append((i, _talk(rng, a, b)))
        tags.append((i, 1, a ^ b))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(tags, "doc_id long, quality int, toxic int")
    got = [r for r in toxicity.judge(docs, labels).collect() if r["held_out"]]
    truth = {i: t for i, _, t in tags}
    wrong = sum((r["score"] >= 0.5) != (truth[r["doc_id"]] == 1) for r in got)
    assert len(got) > 1500 and wrong <= 0.05 * len(got)
    machine = toxicity.fit(docs, labels)
    of = toxicity.Terms()
    one, other, both = machine.scores([of("zounk w1 w2"), of("grolk w1 w2"), of("zounk grolk w1 w2")])
    assert both < 0.4 and one > 0.6 and other > 0.6


@pytest.fixture(scope="module")
def judged(spark):
    return queries.op12_toxicity(spark, "/root/testdata/sf0.1").collect()


def test_held_out_accuracy(spark, judged):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(judged) == documents(spark, "/root/testdata/sf0.1").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in judged)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in judged)
    held = [(r["score"], toxic[r["doc_id"]]) for r in judged if r["held_out"] and r["doc_id"] in toxic]
    flagged = [t for s, t in held if s >= 0.7]
    # a third of the label is noise that no word explains
    assert sum(flagged) >= 0.97 * len(flagged) and sum(flagged) >= 0.45 * sum(t for _, t in held)
    brier = np.mean([(s - t) ** 2 for s, t in held])
    rate = np.mean([t for _, t in held])
    assert brier < 0.6 * rate * (1 - rate)


def test_scores_do_not_depend_on_the_batch(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    machine = toxicity.fit(docs, labels)
    of = toxicity.Terms()
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()]
    together = machine.scores([of(t) for t in texts])
    assert [float(machine.scores([toxicity.Terms()(t)])[0]) for t in texts] == together.tolist()


def test_labels_of_held_out_rows_change_nothing(spark):
    from pyspark.sql import functions as F

    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.withColumn("toxic", F.when(F.expr(toxicity.HELD_OUT), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.factors, b.factors) and a[3:] == b[3:]


def test_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0, 1), (6, 1, 0), (6, 1, 1), (None, 1, 1), (7, None, None), (8, 0, 0), (9, 1, 0), (10, 1, 1), (5, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.judge(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    assert toxicity.judge(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.judge(odd, labels.limit(0)).collect()} == {toxicity.logistic(np.array([-35.0]))[0]}
    assert toxicity.judge(odd, labels.where("toxic = 1")).where("predicted = 0").count() == 0
