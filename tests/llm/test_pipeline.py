"""The pipeline's stages on sf0.001: decisions take effect, columns stay, clean documents are kept."""

import zlib

import pytest

import corpus_pipeline as P
from bazaar.llm.common import documents, stored

from . import brute as B

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = documents(spark, SF)
    out = [docs]
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF))
        out.append(docs)
    return out


def test_columns(steps):
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns
    assert set(steps[0].columns) < set(steps[-1].columns)


def test_language_keeps_prose(steps):
    assert steps[1].count() == 200


def test_near_dedup_keeps_one_of_each(steps):
    rows = steps[1].orderBy("doc_id").collect()
    comps = B.link_components([r["doc_id"] for r in rows], [B.simhash_words(r["text"]) for r in rows])
    assert sorted(r["doc_id"] for r in steps[2].collect()) == sorted(set(comps))


def test_secrets_are_masked(steps):
    before = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    for r in steps[3].collect():
        assert not B.secret_base(r["text"]) and r["n_chars"] == len(r["text"])
        if not B.secret_base(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]


def test_mixture_draws_whole_rows(steps):
    before = {r["doc_id"]: r for r in steps[3].collect()}
    after = steps[4].collect()
    assert all(before[r["doc_id"]] == r for r in after)
    kept = {r["doc_id"] for r in after}
    assert 0.8 * len(before) <= len(kept) < len(before)  # the toxic ones go
    assert 1.1 * len(kept) < len(after) < 1.4 * len(kept)  # the good domain grows by a fourth


def test_tokens_round_trip(steps, spark):
    got = steps[-1].collect()
    assert len(got) == steps[4].count() and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in got)
    assert P.run(spark, SF).count() == len(got)


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
        assert stage(spark, odd, SF).count() > 0, name


def test_held_out_rule_is_crc32(spark):
    ids = [0, 1, 17, 123456789]
    from bazaar.llm.language_id import HELD_OUT

    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").selectExpr("doc_id", f"{HELD_OUT} AS h").collect()
    assert [r["h"] for r in got] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]
