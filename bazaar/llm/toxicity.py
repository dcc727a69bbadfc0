"""Toxicity by a factorization machine over hashed terms.

A text is the set of its words (case folded, cut at everything but letters and digits), each hashed to one of
``BUCKETS`` terms.  Its margin is a bias, a weight per term, and the inner product of the factors of every pair of its
terms, so that an insult and the mention of a group may weigh nothing alone and much together.  All pairs cost one pass:
half of (the square of the sum of factors less the sum of their squares).

Fit: labelled rows that are not held out, at most about ``SAMPLE`` of them picked by a hash of doc_id; proximal adaptive
gradients on the logistic loss, with penalties of absolute weights and of the lengths of factors, so that words that say
nothing weigh nothing.  One in four of these rows is kept out of the fit and calibrates the margin (two numbers), so that a
score is the probability of the label.  The sample's features are computed by Spark; the fit holds them in one array of
a bounded size (``SAMPLE`` rows of at most ``BUCKETS`` terms).

Scoring: one Arrow-batched pass over whole texts with one array of weights and factors, of a fixed size.

Defined results: null, empty or blank text has no term and scores the calibrated bias; rows without a usable label, a
doc_id, or that are held out are not learnt from; of several labels of one doc_id the greatest counts; with no learnt
row, or rows of one label only, every score is the share of that label (0 without any); a null doc_id is not held out;
repeated rows give one output row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
BUCKETS = 1 << 18
SLICE = 1 << 20  # characters of one text handled at a time
FACTORS = 4
SAMPLE = 20_000
SEEN = 3  # a term takes part in the fit if so many rows have it
EPOCHS, ROWS, STEP = 25, 128, 0.1  # passes over the sample, rows a step, step size
SPARSE, JOINT = 3e-3, 8e-3  # penalties of absolute weights and of the lengths of factors
HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1, false)"
KEPT = 1 << 20  # words whose bucket a task remembers


class Terms:
    """Sorted distinct buckets of a text's words; buckets of recent words are remembered, up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        out: set[int] = set()
        for part in _slices(text or ""):
            for word in set(WORD.findall(part.lower())):
                bucket = self.known.get(word)
                if bucket is None:
                    if len(self.known) >= KEPT:
                        self.known.clear()
                    bucket = self.known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % BUCKETS
                out.add(bucket)
        return np.array(sorted(out), np.int64)


def _slices(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SLICE:
        end = text.rfind(" ", start, start + SLICE)
        end = end if end > start else start + SLICE
        yield text[start:end]
        start = end
    yield text[start:]


class Machine(NamedTuple):
    """Bias, weights (terms) and factors (terms x FACTORS); the score is the logistic of ``slope`` margin + ``offset``."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        size = np.array([len(r) for r in rows])
        full = np.flatnonzero(size)
        if len(full):
            table = np.column_stack([self.weights - (self.factors**2).sum(axis=1) / 2, self.factors])
            first = np.append(0, np.cumsum(size[full])[:-1])
            sums = np.add.reduceat(table[np.concatenate([rows[i] for i in full])], first, axis=0)
            out[full] += sums[:, 0] + (sums[:, 1:] ** 2).sum(axis=1) / 2
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return logistic(self.slope * self.margins(rows) + self.offset)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(rows: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Machine:
    """Weights and factors of the labelled rows by proximal adaptive gradients."""
    rng = np.random.default_rng(seed)
    seen = np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]), minlength=BUCKETS) >= SEEN
    used = np.flatnonzero(seen)
    place = np.cumsum(seen) - 1
    rows = [place[r[seen[r]]] for r in rows]
    n = len(used)
    p = (y.sum() + 0.5) / (len(y) + 1)
    bias, w, v = float(np.log(p / (1 - p))), np.zeros(n), rng.normal(0, 0.05, (n, FACTORS))
    gb, gw, gv = 1e-6, np.full(n, 1e-6), np.full(n, 1e-4)
    for epoch in range(EPOCHS):
        joint = JOINT * min(1.0, epoch / (EPOCHS / 2))  # grows: at first factors find what they have to say together
        order = rng.permutation(len(rows))
        for i in range(0, len(order), ROWS):
            part = order[i : i + ROWS]
            size = np.array([len(rows[k]) for k in part])
            part, size = part[size > 0], size[size > 0]
            if not len(part):
                continue
            flat = np.concatenate([rows[k] for k in part])
            first = np.append(0, np.cumsum(size)[:-1])
            fv = v[flat]
            sums = np.add.reduceat(fv, first, axis=0)
            margin = bias + np.add.reduceat(w[flat], first) + ((sums**2).sum(axis=1) - np.add.reduceat((fv**2).sum(axis=1), first)) / 2
            off = (logistic(margin) - y[part]) / len(part)
            each = np.repeat(off, size)
            gb += float(off.sum()) ** 2
            bias -= STEP * float(off.sum()) / np.sqrt(gb)
            g = np.bincount(flat, each, minlength=n)
            gw += g**2
            rate = STEP / np.sqrt(gw)
            w -= rate * g
            w = np.sign(w) * np.maximum(np.abs(w) - rate * SPARSE, 0.0)  # every weight shrinks, also of absent terms
            pull = each[:, None] * (np.repeat(sums, size, axis=0) - fv)
            g = np.column_stack([np.bincount(flat, pull[:, f], minlength=n) for f in range(FACTORS)])
            gv += (g**2).sum(axis=1)
            rate = STEP / np.sqrt(gv)
            v -= rate[:, None] * g
            length = np.sqrt((v**2).sum(axis=1)) + 1e-12
            v *= np.maximum(1 - rate * joint / length, 0.0)[:, None]
    weights, factors = np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS))
    weights[used], factors[used] = w, v
    return Machine(bias, weights, factors)


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic fit of the labels to the margins (Newton steps, labels drawn in a little)."""
    pos = y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
    beta, x = np.array([1.0, 0.0]), np.column_stack([np.clip(margin, -10, 10), np.ones(len(margin))])
    for _ in range(50):
        p = logistic(x @ beta)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - target))
        beta -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-10:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """The calibrated machine of a labelled table (doc_id, toxic)."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~F.expr(HELD_OUT))
    n = known.count()
    part = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_000))
    known = known.where(part < round(min(1.0, sample / max(n, 1)) * 1_000_000)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(known), "doc_id")  # at most about `sample` labels

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Terms()
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "terms": [of(t) for t in b["text"]]})

    got = rows.mapInPandas(terms, "doc_id long, toxic int, terms array<long>").toPandas()  # at most about `sample` rows
    got["terms"] = [np.asarray(t, np.int64) for t in got["terms"]]
    got["size"] = got["terms"].map(len)
    got = got.sort_values(["doc_id", "size"], kind="stable")
    x, y = got["terms"].tolist(), got["toxic"].to_numpy(float)
    none = Machine(0.0, np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)))
    if not len(y) or y.min() == y.max():
        return none._replace(slope=0.0, offset=35.0 if len(y) and y[0] else -35.0)
    rest = (np.array([xxhash.xxh64_intdigest(str(i)) for i in got["doc_id"]], np.uint64) % np.uint64(4)).astype(int) == 0
    if min(y[rest].sum(), (1 - y[rest]).sum(), y[~rest].sum(), (1 - y[~rest]).sum()) < 1:
        return train(x, y)  # too few to keep some out
    machine = train([t for t, r in zip(x, rest, strict=True) if not r], y[~rest])
    slope, offset = calibrate(machine.margins([t for t, r in zip(x, rest, strict=True) if r]), y[rest])
    return machine._replace(slope=slope, offset=offset)


def score(text: Column, machine: Machine) -> Column:
    """The score of a text column."""
    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Terms()
        for texts in batches:
            out = [machine.scores([of(t) for t in texts.iloc[i : i + 512]]) for i in range(0, len(texts), 512)]
            yield pd.Series(np.concatenate([*out, np.zeros(0)]))

    return udf(text)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 where the score is ``threshold`` or more)."""
    scored = docs.select(docs["doc_id"], F.expr(HELD_OUT).alias("held_out"), score(docs["text"], fit(docs, labels, sample)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
