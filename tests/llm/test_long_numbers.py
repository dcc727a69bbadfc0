"""op6: runs of numbers of any length are matched without a call for each of their groups."""

import random

from pyspark.sql import functions as F

from bazaar.llm import private_data as P
from bazaar.llm import spans as S

# the patterns as they are read: greedy, which short texts can be held against
GREEDY = {
    "email": (P.EMAIL, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "card": (P.CARD, r"[0-9](?:[\x20-]?[0-9]){12,}"),
    "dotted": (P.FAMILIES["dotted"], r"[0-9]{1,4}(?:[.:][0-9]{1,4}){3,}"),
    "digits": (P.FAMILIES["digits"], r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}"),
}


def test_long_runs_do_not_overflow_the_stack(spark):
    n = 100_000
    texts = {"digits": "7" * n, "spaced": "1 " * n, "dots": "1.2:" * n, "mail": "a@b" + ".c" * n, "dashes": "1-" * n}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    found = {r["doc_id"]: (r["base"], r["c"]) for r in docs.select(
        "doc_id", S.written(P.base_spans(F.col("text"))).alias("base"),
        F.transform(P.candidates(F.col("text")), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["x"][12].alias("domain"))).alias("c"),
    ).collect()}
    assert found["mail"][0] == f"email:0:{2 * n + 3}"
    spans = {k: [tuple(c) for c in v[1]] for k, v in found.items()}
    assert spans["digits"] == [("digits", 0, n, 0.0)]
    assert spans["spaced"] == spans["dashes"] == [("digits", 0, 2 * n - 1, 0.0)]
    assert spans["mail"] == [("address", 0, 2 * n + 3, 0.0)]
    assert ("dotted", 0, 4 * n - 1, 0.0) in spans["dots"]


def test_possessive_groups_find_what_greedy_ones_find(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("0123456789 -.:/()+@ab_\n ") if rnd.random() < 0.5 else rnd.choice("017 .-") for _ in range(rnd.randint(1, 90))) for _ in range(1500)]
    texts += ["".join(rnd.choice("ab1.@-c ") for _ in range(rnd.randint(3, 14))) for _ in range(1500)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for name, (now, greedy) in GREEDY.items():
        got = docs.select(F.regexp_extract_all("text", F.lit(now), F.lit(0)).alias("a"), F.regexp_extract_all("text", F.lit(greedy), F.lit(0)).alias("b"))
        assert got.where("size(b) > 0").count() > 3, name
        assert got.where("NOT (a <=> b)").count() == 0, name
    old = F.col("text").rlike(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$").cast("double")
    domain = P.features(F.col("text"), F.lit(""), F.lit(""))["domain"]
    # a hit has one at sign
    one = docs.where(F.length("text") - F.length(F.translate("text", "@", "")) == 1).select(old.alias("a"), domain.alias("b"))
    assert one.where("a = 1").count() > 3 and one.where("a <> b").count() == 0
