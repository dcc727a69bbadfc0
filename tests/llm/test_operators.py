"""Each operator against its plain version on sf0.001, and on odd and empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bazaar.llm import (
    host_rules,
    language_id,
    mixing,
    pieces,
    private_data,
    queries,
    resharding,
    secret_scan,
    simhash_near,
    simhash_search,
    substring_dedup,
)
from bazaar.llm.components import components

from . import brute as B

SF = "/root/testdata/sf0.001"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_secret_base_spans(spark, texts):
    got = by_id(queries.op1_secret_scan(spark, SF))
    assert len(got) == len(texts)
    for i, t in texts:
        base = ",".join(f"{k}:{a}:{e}" for a, _, k, e in B.secret_base(t))
        assert got[i]["base_sha256"] == B.sha(base)
        assert set(base.split(",")) <= set(got[i]["spans"].split(",")) | {""}


def test_secret_edges(spark):
    cases = [
        "secret=token: abcdefgh", "token = 'abc'", "API_KEY:\"abcdef\" password=x.y=z/", "AKIAAKIA" + "Z" * 14, "AKIA" + "Z" * 15,
        "é" * 5 + "passwd=abcdef", "0" * 23 + "g" + "a" * 24, "token==abc123", "apikey: :abcdef", "TOKEN=a" + "b" * 30,
    ]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = by_id(secret_scan.scan(rows))
    for i, t in enumerate(cases):
        want = ",".join(f"{k}:{a}:{e}" for a, _, k, e in B.secret_base(t))
        assert got[i]["base_sha256"] == B.sha(want), t


def test_secret_entropy_and_allow_list(spark):
    import math

    key = "q7Zp2LxV9sKd4TwYb1NcR8mGh3Jf"
    hexed = "9F8e7d6c5b4a39281706f5e4d3c2b1a0"
    cases = [f"use {key} here", "plain erberbeeinheitkeiterlichkeit word", "id 123e4567-e89b-12d3-a456-426614174000",
             "a" * 40, "12345678901234567890123", "see some/path/to/module_name/file2"]
    rows = spark.createDataFrame(list(enumerate([*cases, hexed])), "doc_id long, text string")
    got = by_id(secret_scan.scan(rows))
    assert got[0]["spans"] == f"entropy_base64:4:{4 + len(key)}"
    assert [got[i]["n_entropy"] for i in range(1, 6)] == [0] * 5
    assert got[6]["spans"] == f"hex:2:{len(hexed)}"  # its lower-case run is a base span, nothing is added over it
    for s, alphabet in ((key, "entropy_base64"), ("0123456789abcdef0011", "entropy_hex")):
        peak = spark.range(1).select(secret_scan.peak_entropy(F.lit(s), secret_scan.ALPHABET[alphabet])).first()[0]
        windows = [s[i : i + 20] for i in range(len(s) - 19)]
        want = max(-sum(n / 20 * math.log2(n / 20) for n in Counter(w).values()) for w in windows)
        assert abs(peak - want) < 1e-9
    masked = secret_scan.without_secrets(rows.withColumn("n_chars", F.length("text").cast("long")))
    first = masked.where("doc_id = 0").first()
    assert first["text"] == "use <secret> here" and first["n_chars"] == len("use <secret> here")


def test_mixing_meets_targets(spark):
    got = queries.op2_mixing_weights(spark, SF).collect()
    total = {d: sum(r["rate"] * r["tokens"] * r[f"p_{d}"] for r in got) for d in ("good", "low", "toxic")}
    whole = sum(total.values())
    assert all(r["rate"] >= 0 and abs(r["p_good"] + r["p_low"] + r["p_toxic"] - 1) < 1e-9 for r in got)
    for d, w in (("good", 0.8), ("low", 0.15), ("toxic", 0.05)):
        assert abs(total[d] / whole - w) < 0.02
    assert len(got) == 200


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_mixing_descent_equals_numpy(spark, least):
    import numpy as np

    rng = np.random.default_rng(3)
    p = rng.dirichlet([1, 1, 1], 50)
    t = rng.integers(1, 100, 50)
    rows = spark.createDataFrame([(int(n), [float(x) for x in q]) for n, q in zip(t, p, strict=True)], "_tokens long, _p array<double>")
    have = (t[:, None] * p).sum(0)
    target = (t * rng.uniform(0.3 + 0.7 * least, 2, 50)) @ p  # some rates meet it
    history = mixing.fit_rates(rows, target.tolist(), least)
    got = np.array([r["_rate"] for r in mixing._rated(rows, history, least).collect()])
    r = np.ones(50)
    for _ in range(len(history)):
        r = np.maximum(least, r - p @ (((t * r) @ p - target) / have))
    assert np.allclose(got, r) and (got >= least).all()
    assert np.abs((t * got) @ p - target).max() < 1e-4 * have.max()


@pytest.mark.parametrize("start", [None, 9, 35])
def test_substring_dedup(docs, texts, start):
    got = by_id(substring_dedup.dedup(docs, 35, start))
    for (i, _), want in zip(texts, B.substring([t for _, t in texts], 35), strict=True):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == want


@pytest.mark.parametrize("window,start", [(4, 1), (5, None), (6, 2), (3, 3)])
def test_substring_dedup_small_alphabet(spark, window, start):
    import random

    rng = random.Random(window)
    cases = [" ".join(rng.choice("ab" if i % 3 else "abcde") for _ in range(rng.randint(0, 40))) for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").repartition(7)
    got = by_id(substring_dedup.dedup(rows, window, start))
    for i, want in enumerate(B.substring(cases, window)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == want


def test_host_rules(spark, texts):
    got = by_id(queries.op4_host_quality_rules(spark, SF))
    for i, t in texts:
        c = B.rule_counts(t)
        assert tuple(got[i][x] for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == c
        assert got[i]["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert got[i]["kept"] in ((False,) if got[i]["base_failed"] else (True, False))


def test_host_verdict_reaches_documents(spark):
    good = " ".join(f"word{i}" for i in range(60))
    odd = " ".join(f"word{i}###" for i in range(60))
    rows = [(i, odd, "bad") for i in range(30)] + [(100, good, "bad"), (200, odd, "fine")]
    rows += [(300 + i, good + f" x{i}", h) for i in range(30) for h in ("fine", "other")]
    got = defaultdict(set)
    for r in host_rules.verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        got[r["doc_id"]].add(r["kept"])
    assert got[0] == {False} and got[100] == {True} and got[200] == {True} and got[300] == {True}


def test_language_held_out_accuracy(spark, docs):
    got = by_id(language_id.identify(docs))
    held = [(r["lang"], got[r["doc_id"]]) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(g["held_out"] for _, g in held) and sum(g["held_out"] for g in got.values()) == len(held)
    assert sum(a == g["lang_pred"] for a, g in held) >= 0.95 * len(held)


def test_language_mixture(spark, docs):
    model = language_id.fit(docs)
    by = {r["lang"]: r["text"] for r in docs.where("n_chars > 1500").collect()}
    import pandas as pd

    half = by["en"][:1000] + " " + by["de"][:500]
    got = language_id.predict(pd.Series([half, by["en"], "", "123 !!", None]), *model)
    assert got["lang"].tolist() == ["en", "en", "und", "und", "und"]
    assert 0.55 < got["score"][0] < 0.8 and got["score"][1] > 0.9 and got["score"][2] == 0


def test_private_base_spans(spark, texts):
    got = by_id(queries.op6_personal_data(spark, SF))
    for i, t in texts:
        base = ",".join(f"{k}:{a}:{e}" for _, a, k, e in B.private_base(t))
        assert got[i]["base_sha256"] == B.sha(base)
        assert set(base.split(",")) <= set(got[i]["spans"].split(",")) | {""}


def test_private_edges(spark):
    cases = [
        "a@b.c_d@e.f", "a@b@c.d x.@y-.z", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "4111 1111-1111 1111 4111  1111",
        "4111111111111111 4242424242424242", "41111111111111114242424242424242", "+1 (555) 010-2030. +12345 +1..2..3456789",
        "+49 0000000000000000", "é1.2.3.4", "1.2.3.99999999999", "mail: foo.bar+baz@mail.example.co.uk,", "x@y x@y.z.",
    ]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    out = by_id(rows.select("doc_id", private_data.S.written(private_data.S.by_kind(private_data.base_spans(F.col("text")))).alias("s")))
    for i, t in enumerate(cases):
        assert out[i]["s"] == ",".join(f"{k}:{a}:{e}" for _, a, k, e in B.private_base(t)), t


def test_private_trees_add_what_looks_alike(spark):
    """Numbers without a plus in the shape of known phone numbers are added, checksum failures are not."""
    import random

    rng = random.Random(5)
    rows = []
    for i in range(400):
        n = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"some words call +1 {n} and more words {rng.randint(10**15, 10**16 - 1)} end"))
    rows.append((1000, "some words call 1 (212) 555-0199 and more"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    judge = private_data.fit(frame)
    assert judge is not None and set(judge[1]) <= set(private_data.FAMILIES)
    got = by_id(private_data.scan(frame))
    assert all(g["n_phone"] == 1 for i, g in got.items() if i < 1000)
    assert sum(g["n_added"] for i, g in got.items() if i < 1000) <= 20
    clean = private_data.redacted(frame.withColumn("n_chars", F.length("text").cast("long"))).where("doc_id = 3").first()
    assert "<phone>" in clean["text"] and clean["n_chars"] == len(clean["text"])


def test_resharding_plan(spark, texts):
    got = by_id(queries.op7_min_cost_resharding(spark, SF))
    size, slots, old, moved = Counter(), defaultdict(list), Counter(), 0
    for i, t in texts:
        g, n = got[i], len((t or "").encode()) + 8
        assert g["size"] == n and g["text_crc32"] == zlib.crc32((t or "").encode()) and g["law"] == "bytes" and g["grown_shard"] is None
        size[g["shard"]] += n
        old[g["old_shard"]] += n
        slots[g["shard"]].append(g["slot"])
        moved += n * (g["shard"] != g["old_shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    need = sum(max(0, n - sum(size.values()) / 24) for n in old.values())
    assert moved <= 1.1 * need


def test_min_cost_flow_moves_least():
    flow = resharding.min_cost_flow([10, 0, 5], [5, 5, 5])
    assert flow == {(0, 0): 5, (0, 1): 5, (2, 2): 5}
    cost = [[0, 9, 1], [9, 0, 1], [1, 1, 0]]
    flow = resharding.min_cost_flow([8, 0, 0], [2, 6, 0], cost)
    assert sum(n * cost[i][j] for (i, j), n in flow.items()) == 54
    # a later path sends back what an earlier one has placed
    flow = resharding.min_cost_flow([1, 1], [1, 1], [[1, 2], [1, 9]])
    assert flow == {(0, 1): 1, (1, 0): 1}
    with pytest.raises(ValueError):
        resharding.min_cost_flow([3], [1, 1])


def test_resharding_rewrites_affected_files(spark, docs, tmp_path):
    a, b = str(tmp_path / "old"), str(tmp_path / "new")
    resharding.write_shards(docs, a, 6)
    affected = resharding.rewrite(spark, a, b, 6, 8)
    kept = spark.read.parquet(a).where(~F.col("shard").isin(affected))
    new = spark.read.parquet(b)
    assert sorted(r[0] for r in kept.select("doc_id").unionByName(new.select("doc_id")).collect()) == list(range(200))
    assert {r[0] for r in new.select("shard").distinct().collect()} <= set(affected)


def test_pieces_equal_the_library(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)
    got = by_id(queries.op8_piece_encoding(spark, SF))
    for i, t in texts:
        assert list(got[i]["ids"]) == sp.encode(t) and got[i]["n_tokens"] == len(got[i]["ids"]) and got[i]["round_trip"]


def test_pieces_random_strings():
    import random

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)
    p = pieces.Pieces(pieces.load(queries.TOKENIZER), "bpe")
    rng = random.Random(2)
    signs = " \n\tabcdefghijklmnopqrstuvwxyzABCEé中🎉ñ.,<>=-²»́" + " " * 12
    for _ in range(5000):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert p.encode(t).tolist() == sp.encode(t) and p.decode(p.encode(t)) == t
    assert p.decode(p.encode("a ▁ b")) == "a ▁ b"


def test_unigram_viterbi_is_best():
    """Best sum of scores, against trying all segmentations."""
    import functools
    import random

    p = pieces.Pieces(pieces.load(queries.TOKENIZER), "unigram")
    rng = random.Random(4)
    score = {t: -rng.random() * 10 for t in p.ids if set(t) <= set("abct▁he")}
    for t, i in p.ids.items():
        p.score[i] = score.get(t, -1e9)

    @functools.cache
    def best(t):
        return 0.0 if not t else max(score.get(t[:k], -1e9) + best(t[k:]) for k in range(1, len(t) + 1))

    for _ in range(200):
        t = "".join(rng.choice("abcthe") for _ in range(rng.randint(1, 12)))
        assert abs(sum(p.score[i] for i in p.viterbi(t)) - best(t)) < 1e-6


def test_simhash_search(spark, texts):
    got = by_id(queries.op9_simhash_fingerprints(spark, SF))
    prints = {i: int(g["fingerprint"], 16) for i, g in got.items()}
    for n, (i, t) in enumerate(texts):
        after = texts[(n + 1) % len(texts)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        g = got[i]
        assert g["n_chars"] == len(t) and g["edited_sha256"] == B.sha(edited)
        if n % 5 == 0:
            assert prints[i] == B.weighted_simhash(t) and int(g["edited_fingerprint"], 16) == B.weighted_simhash(edited)
            assert g["near_next"] == 1 - (prints[i] ^ B.weighted_simhash(after)).bit_count() / 64
        if i % 20 == 0:
            assert g["n_near"] == sum((prints[i] ^ p).bit_count() <= 3 for p in prints.values()) - 1
        else:
            assert g["n_near"] is None


@pytest.mark.parametrize("ids", [[5], [3, 9], [None, -(2**63), 2**63 - 1, 7]])
def test_simhash_order_edges(spark, ids):
    cases = [(d, f"text number {i} of document {d} with words") for i, d in enumerate(ids)]
    rows = spark.createDataFrame(cases, "doc_id long, text string")
    got = simhash_search.fingerprints(rows).collect()
    order = sorted(cases, key=lambda x: (x[0] is not None, x[0] or 0))
    want = set()
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        want.add((d, B.sha(t[: len(t) - len(t) // 2] + after[: len(t) // 2])))
    assert {(r["doc_id"], r["edited_sha256"]) for r in got} == want


def test_block_tables_find_all_within_radius(spark):
    import random

    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(4)]
    signed = sorted({x - (1 << 64 if x >> 63 else 0) for x in base + near})
    rows = spark.createDataFrame([(x,) for x in signed], "fp long")
    for radius in (1, 3):
        got = {(r["query"], r["fp"]) for r in simhash_search.within_radius(rows, rows, radius).collect()}
        assert got == {(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}


def test_near_duplicates(spark, texts):
    got = by_id(queries.op10_simhash_near_dedup(spark, SF))
    prints = [B.simhash_words(t) for _, t in texts]
    comps = B.link_components([i for i, _ in texts], prints)
    for (i, _), p, c in zip(texts, prints, comps, strict=True):
        assert got[i]["fingerprint"] == f"{p:016x}" and got[i]["component_id"] == c


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_byte_position_index_loses_no_link(spark, bits):
    import random

    rng = random.Random(bits)
    prints = [0]
    for _ in range(600):  # chains, stars and strangers
        p = rng.choice(prints)
        for k in rng.sample(range(64), rng.randint(1, bits + 2)):
            p ^= 1 << k
        prints.append(rng.getrandbits(64) if rng.random() < 0.05 else p)
    ids = list(range(len(prints)))
    frame = spark.createDataFrame([(i, p - (1 << 64 if p >> 63 else 0)) for i, p in zip(ids, prints, strict=True)], "id long, fp long")
    first = {r["fp"]: r["first"] for r in simhash_near.classes(frame, bits, F.col("id")).collect()}
    want = B.link_components(ids, prints, bits)
    assert [first[p - (1 << 64 if p >> 63 else 0)] for p in prints] == want


def test_long_posting_list_is_bounded(spark):
    """Two thousand fingerprints that agree in six bytes: found by neighbours, not by pairs."""
    import numpy as np

    members = np.arange(2000, dtype=np.int64) * 7
    got = simhash_near._forest(members, 2)
    want = B.link_components(members.tolist(), members.tolist(), 2)
    roots = dict(got)
    assert [roots.get(int(m), int(m)) for m in members] == want


@pytest.mark.parametrize("local", [5, 1000])
def test_components(spark, local):
    import random

    rng = random.Random(9)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(300 + i, 301 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(20), local).collect()}
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


OPERATORS = {
    "secrets": secret_scan.scan, "masked": secret_scan.without_secrets, "substring": substring_dedup.dedup,
    "rules": host_rules.verdicts, "language": language_id.identify, "known": language_id.known_language,
    "private": private_data.scan, "redacted": private_data.redacted, "shards": resharding.reshard,
    "pieces": lambda d: pieces.tokens(d, queries.TOKENIZER), "tokenised": lambda d: pieces.tokenised(d, queries.TOKENIZER),
    "search": simhash_search.fingerprints, "near": simhash_near.near_duplicates, "one": simhash_near.one_of_each,
    "mix": lambda d: mixing.mix(d, _labels(d), {"good": 1.0}), "drawn": lambda d: mixing.drawn(d, _labels(d), {"good": 1.0, "low": 1.0}),
}


def _labels(d):
    return d.sparkSession.createDataFrame(
        [(5, 1, 0), (6, 0, 0), (8, 1, 0), (9, 1, 1), (None, 1, 0), (10, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int"
    )


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).collect() == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("one", "known", "drawn")])
def test_odd_rows_each_have_a_result(odd, name):
    got = OPERATORS[name](odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in odd.select("doc_id").collect())


def test_odd_results(odd):
    sub = {r["doc_id"]: r for r in substring_dedup.dedup(odd).where("doc_id IS NOT NULL").collect()}
    assert (sub[1]["n_words"], sub[1]["n_removed"], sub[1]["kept_sha256"]) == (0, 0, EMPTY_SHA)
    assert sub[6]["n_removed"] == 60 and sub[5]["n_removed"] == 24000 and sub[8]["n_removed"] == 0
    near = {r["doc_id"]: r for r in simhash_near.near_duplicates(odd).where("doc_id IS NOT NULL").collect()}
    assert near[1]["fingerprint"] == "0" * 16 and near[2]["component_id"] == 1 and near[7]["component_id"] == 6
    lang = {r["doc_id"]: r for r in language_id.identify(odd).where("doc_id IS NOT NULL").collect()}
    assert [lang[i]["lang_pred"] for i in (1, 2, 3, 9)] == ["und"] * 4
    ids = {r["doc_id"]: r for r in pieces.tokens(odd, queries.TOKENIZER).where("doc_id IS NOT NULL").collect()}
    assert ids[1]["ids"] is None and ids[1]["n_tokens"] == 0 and list(ids[2]["ids"]) == [] and ids[10]["round_trip"] and ids[5]["round_trip"]
    rules = {r["doc_id"]: r for r in host_rules.verdicts(odd).where("doc_id IS NOT NULL").collect()}
    assert not rules[1]["kept"] and rules[1]["n_words"] == 0 and rules[5]["n_repeat_words"] == 24000


def test_one_of_each_keeps_whole_rows(odd):
    got = simhash_near.one_of_each(odd)
    assert got.columns == odd.columns
    rows = got.collect()
    assert sorted(r["doc_id"] or -1 for r in rows) == [-1, 1, 5, 6, 8, 9, 10]


@pytest.mark.parametrize("share", [0.0, 0.02, 0.6])
def test_mixing_drops_toxic_documents_whatever_their_share(spark, share):
    import random

    rng = random.Random(11)
    plain, bad = [f"word{i}" for i in range(300)], ["Idiot", "MORON", "scum###", "loser!!"]
    text = lambda toxic: " ".join([rng.choice(plain) for _ in range(40)] + rng.sample(bad, 3 * toxic))
    known = [(i, i % 4 == 0) for i in range(400)]
    rest = [(1000 + i, i < round(600 * share)) for i in range(600)]
    docs = spark.createDataFrame([(i, text(t)) for i, t in known + rest], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 % 2, int(t)) for i, t in known], "doc_id long, quality int, toxic int")
    got = Counter(r["doc_id"] for r in mixing.drawn(docs, labels, {"good": 1.0, "low": 1.0, "toxic": 0.0}).collect())
    assert got == Counter(i for i, t in known + rest if not t)


def test_mixing_words_fold_case_and_signs(spark):
    rows = spark.createDataFrame([(t,) for t in ("idiot", "IDIOT!!", "idiot###", "(Idiot)")], "_text string")
    got = mixing._featured(rows).selectExpr("array_contains(_b, xxhash64('idiot') & 65535L) AS x").collect()
    assert all(r["x"] for r in got)


def test_random_hex_keys_of_any_case_are_found(spark):
    import random

    rng = random.Random(5)
    keys = ["".join(rng.choice(digits) for _ in range(n)) for digits in ("0123456789ABCDEF", "0123456789abcdefABCDEF")
            for n in (24, 32, 40, 64) for _ in range(25)]
    rows = spark.createDataFrame([(i, f"key {k} end") for i, k in enumerate(keys)], "doc_id long, text string")
    found = [r["spans"] == f"entropy_hex:4:{4 + len(keys[r['doc_id']])}" for r in secret_scan.scan(rows).collect()]
    assert sum(found) >= 0.95 * len(keys)


def test_secrets_masks_hex_of_any_case(spark):
    keys = ["9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "9F8e7D6c5B4a39281706F5e4D3c2B1a0", "0F1E2D3C4B5A69788796A5B4"]
    rest = ["123E4567-E89B-12D3-A456-426614174000", "DEADBEEFDEADBEEFDEADBEEF", "A" * 30, "0A" * 15]
    rows = spark.createDataFrame([(i, f"key {k} end") for i, k in enumerate(keys + rest)], "doc_id long, text string")
    got = by_id(secret_scan.without_secrets(rows))
    assert [got[i]["text"] for i in range(len(keys))] == ["key <secret> end"] * len(keys)
    assert [got[len(keys) + i]["text"] for i in range(len(rest))] == [f"key {k} end" for k in rest]
