"""The rows that mixing's classifier is fitted on: as counted by hand, and without a name for each place of the vectors."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from bazaar.llm import mixing

TEXTS = ["red apple pie", "red pear", None, "green pear ## !! ##", "one", "", "apple apple tart", "## !! ##"]


@pytest.fixture()
def fitted(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{t} only{i}" if t else t) for i, t in enumerate(TEXTS * 5)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"), (F.col("doc_id") % 7 == 0).cast("int").alias("toxic"))
    seen, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, rows, *a: seen.append(rows) or fit(self, rows, *a))
    rows = mixing._labelled(docs, labels)
    model = mixing._fitted(rows)
    return rows.collect(), seen[0], model


def test_places_have_no_names_in_the_schema(fitted):
    assert not fitted[1].schema["_x"].metadata


def test_vectors_hold_the_buckets_of_two_documents_or_more(fitted):
    rows, seen, model = fitted
    n = Counter(b for r in rows for b in r["_b"])
    told = sorted(b for b in n if n[b] > 1)
    vectors = [r["_x"] for r in seen.collect()]
    assert {v.size for v in vectors} == {len(told)} and {x for v in vectors for x in v.values} == {1.0}
    got = Counter(tuple(told[i] for i in v.indices) for v in vectors)
    assert got == Counter(tuple(sorted(set(r["_b"]) & set(told))) for r in rows)
    assert not model.weights[:, sorted(set(range(mixing.BUCKETS + 1)) - set(told))].any()


def test_no_bucket_twice_leaves_the_shares_of_the_domains(spark):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(8)], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 2, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
    model = mixing.fit(docs, labels)
    assert model.domains == ["good", "low"] and not model.weights.any()
    assert model.intercepts[1] - model.intercepts[0] == pytest.approx(1.0986, abs=1e-3)
