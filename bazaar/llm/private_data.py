"""Personal data: base formats, and candidates judged by gradient-boosted trees with calibrated thresholds.

Generators with high recall propose overlapping spans (anything around an at sign, dotted numbers, runs of digits with
separators).  Each candidate has features of its format (length, digits, groups, separators, checks) and context (the
characters around it, words before it).  Trees are boosted on the candidates of two texts in three, which are labelled
by whether the base formats hold them whole; they learn what such spans look like, not the formats' exact limits.
Candidates with the same features and label are one row with their number as its weight, so the fit reads no more rows
than there are different ones.  On the other texts, each family's threshold is calibrated: at least ``LEAST``, and no
lower than what all but ``MISS`` of that family's true spans reach, by exact counts.  Candidates of all documents that reach it are
selected; base spans always stay, and of overlapping additions the best score wins.

The boosted trees are read back as column expressions, so scoring is part of the one scan over the documents: no
Python, no shuffle, no join.

Defined results: null text counts as empty; empty text has no spans; with no true or no false candidate in the texts
that are fitted there is nothing to learn and nothing is added; repeated rows give one output row each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.ranks import running_totals
from bazaar.llm import spans as S
from bazaar.llm.common import cut, packed, with_text

# Groups are repeated possessively: what may follow one iteration is never part of it, so no match is lost, and the matcher
# loops over them.  It would call itself for each iteration of a greedy group, and a run of some thousand numbers would
# overflow the stack of the task and end the executor.
# A run of address characters is tried from its first character only (or where the last match ended).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
# A greedy run has 13 digits or more as a whole or not at all, so the lower limit may stand in the pattern.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")

#: Families of candidates; an addition carries its family's name.
FAMILIES = {
    "address": r"(?:\G|(?<![^\s@<>]))[^\s@<>]++\x20?(?:@|\(at\)|\[at\])\x20?[^\s@<>]+",
    "dotted": r"[0-9]{1,4}(?:[.:][0-9]{1,4}){3,}+",
    "digits": r"[+(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+",
}
SOURCES = {"address": ("email",), "dotted": ("ip",), "digits": ("card", "phone")}

TREES, DEPTH = 20, 3
LEAST, MISS = 0.5, 0.05
NEAR = 24  # characters of context on each side


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backward = F.split(F.reverse(digits), "")
    def value(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(F.transform(backward, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _is_ip(hit: Column) -> Column:
    small = lambda part: (F.length(F.regexp_replace(part, "^0+", "")) <= 3) & (
        F.coalesce(F.substring(F.regexp_replace(part, "^0+(?=.)", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255
    )
    return F.forall(F.split(hit, r"\."), small)


def _is_card(hit: Column) -> Column:
    digits = _digits(hit)
    return F.length(digits).between(13, 19) & luhn(digits)


def base_spans(text: Column) -> Column:
    """Base spans, by start then kind."""
    return S.together(
        S.of_kind(S.find(text, EMAIL), "email", 0),
        S.of_kind(S.find(text, IP), "ip", 1, _is_ip),
        S.of_kind(S.find(text, CARD), "card", 2, _is_card),
        S.of_kind(S.find(text, PHONE), "phone", 3, lambda h: F.length(_digits(h)).between(9, 15)),
    )


def features(hit: Column, before: Column, after: Column) -> dict[str, Column]:
    """Features by name, over a candidate's string, the text before it and the text after it."""
    digits = _digits(hit)
    n = F.length(hit)
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    count = lambda chars: n - F.length(F.regexp_replace(hit, chars, ""))
    return {
        "length": number(n),
        "n_digits": number(F.length(digits)),
        "n_letters": number(count("[A-Za-z]")),
        "n_dots": number(count(r"\.")),
        "n_spaces": number(count(r"\x20")),
        "n_dashes": number(count("-")),
        "n_parens": number(count(r"[()]")),
        "n_slashes": number(count("[/:]")),
        "plus": number(hit.startswith("+")),
        "groups": number(F.size(F.split(F.trim(F.regexp_replace(hit, "[^0-9]+", " ")), " "))),
        "distinct": number(F.size(F.array_distinct(F.split(digits, "")))),
        "luhn": number((F.length(digits) > 0) & luhn(digits)),
        "domain": number(hit.rlike(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$") & hit.rlike(r"\.[A-Za-z]{2,}$")),
        "largest": number(F.coalesce(F.array_max(F.transform(
            F.split(hit, "[^0-9]+"), lambda p: F.when(F.length(p) <= 9, p.try_cast("int")).otherwise(F.lit(999_999_999))
        )), F.lit(0))),
        "touches_before": number(before.rlike(r"[A-Za-z0-9_]$")),
        "touches_after": number(after.rlike("^[A-Za-z0-9_]")),
        "says_phone": number(before.rlike("(?i)(tel|phone|call|mobile|fax)")),
        "says_mail": number(before.rlike("(?i)(mail|contact|write)")),
        "says_card": number(before.rlike("(?i)(card|visa|account|iban|payment)")),
        "says_other": number(before.rlike("(?i)(version|isbn|order|id|no|page|ver)[.:# ]*$")),
    }


FEATURES = [
    "length", "n_digits", "n_letters", "n_dots", "n_spaces", "n_dashes", "n_parens", "n_slashes", "plus", "groups",
    "distinct", "luhn", "domain", "largest", "touches_before", "touches_after", "says_phone", "says_mail", "says_card",
    "says_other",
]


def candidates(text: Column) -> Column:
    """Array of (start, rank, kind, end, hit, x): all families' spans with their features."""
    spans = S.together(*[S.of_kind(S.find(text, p), kind, len(BASE) + k) for k, (kind, p) in enumerate(FAMILIES.items())])

    def described(s: Column) -> Column:
        begin = F.greatest(s["start"] - NEAR, F.lit(0))
        before = F.substring(text, begin + 1, s["start"] - begin)
        after = F.substring(text, s["end"] + 1, F.lit(NEAR))
        known = features(s["hit"], before, after)
        x = F.array(*[known[f] for f in FEATURES])
        return F.struct(*[s[c].alias(c) for c in ("start", "rank", "kind", "end", "hit")], x.alias("x"))

    return F.transform(spans, described)


def _examples(docs: DataFrame) -> DataFrame:
    """Labelled candidates of all documents, equal ones as one row: kind, x, label, held (for calibration), n."""
    rows = docs.select("text").where(F.col("text").isNotNull())
    rows = rows.select(base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("c"), F.pmod(F.xxhash64("text"), F.lit(3)).alias("p"))
    each = rows.select("base", "p", F.explode("c").alias("c"))
    whole = F.exists("base", lambda b: (b["start"] <= F.col("c.start") + 1) & (b["end"] >= F.col("c.end") - 1))
    each = each.select("c.kind", "c.x", whole.cast("double").alias("label"), (F.col("p") == 0).alias("held"))
    return each.groupBy("kind", "x", "label", "held").agg(F.count(F.lit(1)).alias("n"))


def _tree(lines: list[str], x: Column) -> Column:
    """A column expression of a printed regression tree."""
    head = lines.pop(0).strip()
    if head.startswith("Predict:"):
        return F.lit(float(head.split(":")[1]))
    index, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", head).groups()
    yes = _tree(lines, x)
    lines.pop(0)  # Else
    no = _tree(lines, x)
    return F.when(F.element_at(x, int(index) + 1) <= float(limit), yes).otherwise(no)


def _score(model: GBTClassificationModel) -> list[tuple[float, list[str]]]:
    """Weight and printed lines of each boosted tree."""
    return [(w, t.toDebugString.splitlines()[1:]) for t, w in zip(model.trees, model.treeWeights, strict=True)]


def score(trees: list[tuple[float, list[str]]], x: Column) -> Column:
    """Probability that the boosted trees give."""
    total = sum((F.lit(w) * _tree(list(lines), x) for w, lines in trees), F.lit(0.0))
    return 1 / (1 + F.exp(-2 * total))


Judge = tuple[list[tuple[float, list[str]]], dict[str, float]]


def fit(docs: DataFrame) -> Judge | None:
    """Boosted trees and the threshold of each family; None where there is only one kind of candidate to learn from."""
    rows = cut(_examples(docs).withColumns({f: F.element_at("x", i + 1) for i, f in enumerate(FEATURES)}))
    known = rows.where("NOT held")
    if known.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # partitions follow the rows: each tree is several jobs, and few rows in many tasks are mostly waiting
    fitted = assembler.transform(known).select("features", "label", F.col("n").cast("double").alias("weight"))
    fitted = cut(fitted.coalesce(max(4, rows.count() // 50_000)))
    trees = _score(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, weightCol="weight", seed=7).fit(fitted))
    held = rows.where("held AND label = 1").groupBy("kind", score(trees, F.col("x")).alias("q")).agg(F.sum("n").alias("n"))
    passed = running_totals(held, ["kind"], "q", ["n"]).where(F.col("n_before") + F.col("n") >= MISS * F.col("n_total"))
    reach = {r["kind"]: r["q"] for r in passed.groupBy("kind").agg(F.min("q").alias("q")).collect()}
    # a family without any true span in the texts kept out has no threshold to calibrate, so nothing of it is selected
    return trees, {kind: max(LEAST, reach[kind]) for kind in FAMILIES if kind in reach}


def added_spans(text: Column, base: Column, judge: Judge | None) -> Column:
    """Selected candidates that touch no base span and no better addition."""
    if judge is None or not judge[1]:
        return F.array().cast(S.SPANS)
    trees, limits = judge
    limit = F.create_map(*[F.lit(v) for kv in limits.items() for v in kv])
    judged = F.transform(S.apart(candidates(text), base), lambda c: F.struct(c.alias("c"), score(trees, c["x"]).alias("p")))
    good = F.filter(judged, lambda j: j["p"] >= F.coalesce(F.element_at(limit, j["c"]["kind"]), F.lit(2.0)))

    def better(a: Column, b: Column) -> Column:
        """a touches b and comes first by score, then by place."""
        meets = (a["c"]["start"] < b["c"]["end"]) & (a["c"]["end"] > b["c"]["start"])
        ahead = F.struct(-a["p"], a["c"]["start"], a["c"]["rank"]) < F.struct(-b["p"], b["c"]["start"], b["c"]["rank"])
        return meets & ahead

    chosen = F.filter(good, lambda j: ~F.exists(good, lambda o: better(o, j)))
    return F.transform(chosen, lambda j: F.struct(*[j["c"][c].alias(c) for c in ("start", "rank", "kind", "end", "hit")]))


def found(docs: DataFrame) -> DataFrame:
    """doc_id, text, base and added spans."""
    rows = docs.select(docs["doc_id"], docs["text"])
    judge = fit(rows)
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("base", base_spans(F.col("text")))
    return rows.withColumn("added", added_spans(F.col("text"), F.col("base"), judge))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, base_sha256, n_added, spans."""
    base, added = F.col("base"), F.col("added")
    return found(docs).select(
        "doc_id", *[S.number(base, k).alias(f"n_{k}") for k in BASE],
        F.sha2(S.written(S.by_kind(base)), 256).alias("base_sha256"), F.size(added).cast("long").alias("n_added"),
        S.written(S.by_kind(S.together(base, added))).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The input's rows with every selected span replaced by its kind; n_chars follows, null text stays null."""
    judge = fit(docs.select("text"))
    rows = packed(docs, "text").withColumn("_text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("_base", base_spans(F.col("_text")))
    rows = rows.withColumn("_added", added_spans(F.col("_text"), F.col("_base"), judge))
    clean = S.masked(F.col("text"), S.together(F.col("_base"), F.col("_added")), lambda kind: F.concat(F.lit("<"), kind, F.lit(">")))
    return with_text(rows, docs.columns, clean)
