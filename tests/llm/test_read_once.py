"""Mixing takes every text apart once: the fit, the limits and the scores read the features that were kept."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.llm import mixing

TEXTS = ["", " ", ".,", "a b", " a.b,c ", "x\ty\x0bz\x0c\r\n", "één twee…drie", "## !! a##b", None, "no\x85gap a b"]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS * 8)), "doc_id long, text string")


def test_texts_are_taken_apart_once(docs, monkeypatch):
    seen, featured = [], mixing._featured
    monkeypatch.setattr(mixing, "_featured", lambda rows: seen.append(1) or featured(rows))
    labels = docs.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("quality"), (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    assert mixing.mix(docs, labels, {"good": 0.9, "low": 0.1}).count() == len(TEXTS) * 8
    assert len(seen) == 1
    mixing.drawn(docs, labels, {"good": 1.0, "low": 1.0, "toxic": 0.0}).count()
    assert len(seen) == 2


def test_tokens_are_runs_between_gaps(docs):
    got = {r["doc_id"]: r["_tokens"] for r in mixing._featured(mixing._rows(docs)).collect()}
    assert all(got[i] == len(re.findall(r"[^\x20\x09-\x0D.,]+", t or "")) for i, t in enumerate(TEXTS * 8))


@pytest.mark.parametrize("few", [0, 1000])
def test_posteriors_add_up_all_weights(docs, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW", few)
    read = mixing._read(mixing._rows(docs))
    weights = np.zeros((3, mixing.BUCKETS + 1))
    used = sorted({b for r in read.collect() for b in r["_b"]})[::2]
    weights[1, used], weights[2, used[:3]] = np.linspace(-1, 1, len(used)), 0.7
    base = np.array([0.1, -0.2, 0.3])
    got = mixing.Classifier(["a", "b", "c"], weights, base).posteriors(read)
    assert "_b" not in got.columns
    rows = {r["doc_id"]: r["_b"] for r in read.collect()}
    for r in got.collect():
        e = np.exp(base + weights[:, rows[r["doc_id"]]].sum(axis=1))
        assert np.allclose(r["_p"], e / e.sum())


def test_no_row_carries_the_weights(docs):
    weights = np.zeros((3, mixing.BUCKETS + 1))
    weights[1:, :40] = 0.5
    got = mixing.Classifier(["a", "b", "c"], weights, np.zeros(3)).posteriors(mixing._read(mixing._rows(docs)))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and not re.search(r" AS _w\d", plan)
