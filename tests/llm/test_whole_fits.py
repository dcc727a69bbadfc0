"""Models and thresholds learn from every row, not from a bounded sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from bazaar.llm import mixing, private_data


def _limit(p: np.ndarray, member: np.ndarray) -> float:
    at = np.unique(np.concatenate([[0.0], p, [1.0]]))
    wrong = np.array([(p[member] <= a).sum() + (p[~member] > a).sum() for a in at[:-1]])
    gaps = np.where(wrong == wrong.min(), np.diff(at), 0.0)
    k = int(gaps.argmax())
    return float((at[k] + at[k + 1]) / 2)


def test_every_document_gives_examples(spark):
    docs = spark.range(45_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("write to a@b.cd or 10.0.0.1 at "), F.col("id").cast("string")).alias("text"))
    got = {r["kind"]: r["n"] for r in private_data._examples(docs).groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    assert got == {"address": 45_000, "dotted": 45_000} | {k: n for k, n in got.items() if k == "digits"}


def test_every_labelled_document_is_fitted(spark):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert mixing._labelled(docs, labels).count() == 12_000


def test_limit_of_equals_all_limits_tried(spark):
    rng = np.random.default_rng(3)
    for n, grid in ((1, 4), (7, 5), (40, 10), (300, 10**6), (300, 12)):
        p, member = rng.integers(0, grid + 1, n) / grid, rng.random(n) < 0.4
        rows = spark.createDataFrame([(float(a), bool(b)) for a, b in zip(p, member, strict=True)], "p double, member boolean")
        assert mixing.limit_of(rows) == _limit(p, member)
