"""Phrase collocations against plain counting; double arrays against lookups."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bazaar.llm import phrases, queries
from bazaar.llm.common import documents

SF = "/root/testdata/sf0.001"


def plain(rows, least=10, top=2000, cover=50):
    f = defaultdict(Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        found = [(p, a) for p, a in c.items() if len(p) > 1 and a >= least]
        held = Counter()
        for p, a in found:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    held[q] = max(held[q], a)
        kept = []
        for p, a in found:
            if held[p] and 100 * held[p] >= cover * a:
                continue
            score, _, left, right = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_against_plain_counts(spark):
    got = told(queries.op13_phrase_collocations(spark, SF))
    assert got == plain([(r["lang"], r["text"]) for r in documents(spark, SF).collect()]) and len(got) > 100


def _noise(seed, n):
    rnd = random.Random(seed)
    words = ["a", "A", "b", "é", "中文", "x\x00y", "ab", "abc", "-", "#1", "don't", " "]
    breaks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \n ", "\r\n", "\x0b", "!?"]
    return [(rnd.choice(["en", "de", None]), "".join(rnd.choice(words) + rnd.choice(breaks) for _ in range(rnd.randint(0, 80)))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_noise_in_many_shards_waves_and_chunks(spark, monkeypatch, seed):
    monkeypatch.setattr(phrases, "SHARD", 300)
    monkeypatch.setattr(phrases, "WAVE", 6000)
    monkeypatch.setattr(phrases, "BLOCK", 8)
    rows = _noise(seed, 120)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert told(phrases.collocations(docs)) == plain(rows)
    assert told(phrases.collocations(docs, least=3, top=7, cover=90)) == plain(rows, 3, 7, 90)


def test_chunks_keep_texts_and_pieces_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(phrases, "CHUNK", 10)
    batch = pa.record_batch({"lang": ["en", "de", "en", "en"], "text": ["A  b.\tc", None, " d\n\n e ", ""]})
    got = list(phrases._chunks(iter([batch])))
    assert b"".join(d for _, d in got).split() == [b"a", b"b", b"c", b"d", b"e"]
    assert all(k == "en" for k, _ in got)


def test_double_array_accepts_just_its_phrases():
    rnd = random.Random(5)
    known = sorted({" ".join("".join(rnd.choice("abé") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 3))).encode() for _ in range(400)})
    arrays = phrases.double_array(known)
    for _ in range(300):
        text = " ".join("".join(rnd.choice("abé") for _ in range(rnd.randint(1, 4))) for _ in range(12)).encode() + b"\n"
        data = np.frombuffer(text, np.uint8)
        gap = (data == 32) | (data == 10)
        starts = np.flatnonzero(~gap & np.append(True, gap[:-1]))
        got = Counter(known[i] for part in phrases.walk(data, starts, *arrays) for i in part.tolist())
        w = text[:-1].split(b" ")
        want = Counter(b" ".join(w[i : i + k]) for i in range(len(w)) for k in (1, 2, 3) if i + k <= len(w))
        assert got == Counter({p: n for p, n in want.items() if p in set(known)})
    assert list(phrases.walk(np.frombuffer(b"x y\n", np.uint8), np.array([0]), *phrases.double_array([b"x y"])))[-1].tolist() == [0]


def test_score_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3 * 10**12 + 7, 5 * 10**12 + 1, 4 * 10**12 + 3
    got = spark.range(1).select(phrases._score(*[F.lit(x).cast("long") for x in (a, left, right)])).first()[0]
    assert got == 1_000_000 * a * a // (left * right)


def test_odd_and_empty(spark, odd, empty):
    got = told(phrases.collocations(odd))
    assert got == plain([(r["lang"], r["text"]) for r in odd.collect()])
    assert ("en", 1) in {r[:2] for r in got}
    assert phrases.collocations(empty).count() == 0


def test_each_start_walks_one_shard_and_texts_are_joined_once(spark, monkeypatch):
    """However many shards and waves there are, no start is walked twice, and only the first pass reads the texts."""
    rnd = random.Random(2)
    words = [f"{rnd.choice('abcdef')}{'x' * (k % 13)}{k}" for k in range(60)]
    text = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 300))) + rnd.choice([".", "", " "]) for _ in range(40)]
    data = next(phrases._chunks(iter([phrases.pa.record_batch({"lang": ["en"] * 40, "text": text})])))[1]
    parts = phrases._by_shard(np.frombuffer(data, np.uint8), 7)
    piece = [w for line in data.split(b"\n") for w in zip(line.split(b" "), line.split(b" ")[1:])]
    starts = np.sort(np.concatenate(parts))
    assert len(parts) == 7 and len(starts) == len(piece) == len(set(starts.tolist()))
    owner = defaultdict(set)
    for shard, own in enumerate(parts):
        for s in own.tolist():
            owner[tuple(re.split(rb"[ \n]", data[s : s + 60])[:2])].add(shard)
    assert all(len(v) == 1 for v in owner.values()) and set(owner) == set(piece)

    passes = []
    real = phrases._over
    monkeypatch.setattr(phrases, "_over", lambda docs, step, schema: passes.append(schema) or real(docs, step, schema))
    monkeypatch.setattr(phrases, "SHARD", 12000)
    monkeypatch.setattr(phrases, "WAVE", 3000)
    docs = spark.createDataFrame([("en", x) for x in text], "lang string, text string").repartition(3)
    known = sorted({b" ".join(p).decode() for p in piece})
    got = phrases.count_phrases(docs, spark.createDataFrame([("en", p) for p in known], "lang string, phrase string"))
    want = Counter(b" ".join(p).decode() for line in text for p in zip(line.strip(". ").encode().split(b" "), line.strip(". ").encode().split(b" ")[1:]))
    assert {r["phrase"]: r["n"] for r in got.collect()} == dict(want)
    assert len(passes) == 1 and "w3 binary" in passes[0]
