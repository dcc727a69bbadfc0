"""Periodic runs against a plain search over all periods."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.llm import periodic_runs, queries
from bazaar.llm.common import documents

from . import brute as B

SF = "/root/testdata/sf0.001"


def plain_runs(x):
    """Every period, every stretch; the first (smallest) period of a stretch counts."""
    out = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j if j > i else i + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def edited(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(words):
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(((s - e, s, q) for s, e, q in runs), default=None)
    first = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted((s, e, q) for s, e, q in runs))
    return len(runs), *first, B.sha(lines), B.sha(" ".join(w for i, w in enumerate(words) if i not in gone))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_all_periods(spark):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect() if len(B.words(r["text"])) < 1500}
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == documents(spark, SF).count()
    seen = 0
    for i, text in texts.items():
        assert tuple(got[i][c] for c in COLUMNS) == expected(edited(i, B.words(text))), i
        seen += got[i]["n_runs"]
    assert seen > 5 and len(texts) > 150


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            n, k = rnd.choice([0, 5, 11, 12, 13, 40, 150, 400]), rnd.choice([1, 2, 3, 9, 60])
            x = [rnd.randrange(k) for _ in range(n)]
            if n and rnd.random() < 0.7:
                a = rnd.randrange(n)
                p = 1 + rnd.randrange(max(1, (n - a) // 2))
                x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
            texts.append(x)
        end = np.cumsum([len(x) for x in texts])
        base = np.append(0, end[:-1])
        full = np.flatnonzero(end > base)
        runs = periodic_runs.find_runs(np.array([v for x in texts for v in x], np.int64), base[full], end[full])
        want = sorted((int(o) + s, int(o) + e, q) for o, x in zip(base, texts) for s, e, q in plain_runs(x))
        assert sorted(zip(*(c.tolist() for c in runs))) == want


def test_words_of_fibonacci_and_shared_labels():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    big = np.array([x * 10**6 + 7 for x in b])  # ids far over the labels
    runs = periodic_runs.find_runs(big, np.array([0]), np.array([len(b)]))
    assert sorted(zip(*(c.tolist() for c in runs))) == plain_runs(b)
    # ids that fall on one label although the words differ
    tops = [periodic_runs.isqrt((periodic_runs.PRIME - 1) // (2 * b)) for b in (2, 4, 8)]
    ids = np.arange(3000) * tops[0] * tops[1] * tops[2]
    runs = periodic_runs.find_runs(ids, np.array([0]), np.array([3000]))
    assert len(runs.start) == 0


def test_transform_is_exact():
    rng = np.random.default_rng(0)
    for b in (2, 8, 64, 512):
        top = int(((periodic_runs.PRIME - 1) // (2 * b)) ** 0.5)
        x, y = rng.integers(0, top, (b, 3)).astype(np.uint64), rng.integers(0, top, (3 * b - 1, 3)).astype(np.uint64)
        got = periodic_runs.correlations(x, y, 2 * b)
        want = [[int((x[:, c] * y[t : t + b, c]).sum()) for c in range(3)] for t in range(2 * b)]
        assert got.tolist() == want


def test_one_word_repeated_a_hundred_thousand_times(spark):
    rows = spark.createDataFrame([(1, "a " * 100_000), (2, ("lorem ipsum dolor " * 30_000) + "end")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs.collapse(rows).collect()}
    assert (got[1]["n_runs"], got[1]["length"], got[1]["period"], got[1]["exponent_milli"]) == (1, 100_000, 1, 100_000_000)
    assert got[1]["collapsed_sha256"] == B.sha("a")
    assert (got[2]["start"], got[2]["length"], got[2]["period"]) == (0, 90_000, 3)
    assert got[2]["collapsed_sha256"] == B.sha("lorem ipsum dolor end")


def test_odd_and_empty(spark, odd, empty):
    got = periodic_runs.collapse(periodic_runs.with_planted_runs(odd)).collect()
    assert len(got) == odd.count() and periodic_runs.collapse(empty).count() == 0
    rows = [r for r in got if r["n_words"] == 0]
    assert rows and all(r["n_runs"] == 0 and r["start"] is None and r["collapsed_sha256"] == B.sha("") == r["runs_sha256"] for r in rows)
    assert {r["n_runs"] for r in got if r["doc_id"] == 5} == {1}
    want = odd.where(F.col("doc_id") == 6).select("text").first()[0]
    assert [r["collapsed_sha256"] for r in got if r["doc_id"] == 6] == [expected(edited(6, B.words(want)))[-1]] * 2
