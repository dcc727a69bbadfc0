"""Secret scans: format rules, and sliding-window Shannon entropy per character class with allow-list suppression.

Everything is a native column expression over one scan; nothing is shuffled.

Formats: assignments to secret-like names, access key ids, long hexadecimal runs.  Entropy: candidate strings are runs
of key characters of at least ``WINDOW`` characters; their class is hexadecimal (of either case, judged case-folded) or
base-64; a window of ``WINDOW`` characters slides over a candidate, the counts of its characters change by the one that enters and the one that
leaves, and so does the sum of n log n from which the entropy follows.  A candidate is a secret if any window reaches
its class's threshold, unless the allow list knows it (words of letters only, numbers only, UUIDs, paths, one
character repeated) or a format rule has found it already.

Defined results: null text counts as empty; empty text has no spans; repeated rows give one output row each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import spans as S
from bazaar.llm.common import packed, with_text

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A greedy run of a class is either long enough as a whole or not at all, so the length limit may stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")

WINDOW = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}+"
ALPHABET = {
    "entropy_hex": "0123456789abcdef",
    "entropy_base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
}
#: Bits a character that a window must reach; a window of 20 characters has log2(20) = 4.32 at most.
BITS = {"entropy_hex": 3.0, "entropy_base64": 3.7}
#: Harmless strings that can look random.
ALLOW = [
    r"[A-Za-z/_=+-]+",
    r"[0-9/_=+-]+",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?:[A-Za-z]+[0-9]{0,4}[/_=+-]+)+[A-Za-z]*[0-9]{0,4}",
    r"(.)\1+",
]


def format_spans(text: Column) -> Column:
    """Base spans, by start then kind."""
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= 6
    return S.together(
        S.of_kind(S.find(text, ASSIGN), "assign", 0, value),
        S.of_kind(S.find(text, ACCESS), "access", 1),
        S.of_kind(S.find(text, HEX), "hex", 2),
    )


def peak_entropy(string: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Greatest entropy of a window of the string, by incremental counts (0 if the string is shorter)."""
    n_log_n = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])
    chars = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(alphabet), c))
    moves = F.transform(chars, lambda c, i: F.struct(
        c.alias("enter"), F.when(i >= window, F.get(chars, i - window)).otherwise(F.lit(0)).alias("leave"), i.alias("i"),
    ))
    f = lambda n: F.element_at(n_log_n, n + 1)

    def step(acc: Column, m: Column) -> Column:
        same = m["enter"] == m["leave"]
        more = F.element_at(acc["counts"], m["enter"])
        less = F.element_at(acc["counts"], F.greatest(m["leave"], F.lit(1)))
        change = f(more + 1) - f(more) + F.when(m["leave"] > 0, f(F.greatest(less - 1, F.lit(0))) - f(less)).otherwise(0.0)
        total = F.when(same, acc["total"]).otherwise(acc["total"] + change)
        counts = F.transform(acc["counts"], lambda n, j: n + (j + 1 == m["enter"]).cast("int") - (j + 1 == m["leave"]).cast("int"))
        bits = F.lit(math.log2(window)) - total / window
        return F.struct(
            F.when(same, acc["counts"]).otherwise(counts).alias("counts"), total.alias("total"),
            F.when(m["i"] >= window - 1, F.greatest(acc["peak"], bits)).otherwise(acc["peak"]).alias("peak"),
        )

    begin = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("peak"))
    return F.aggregate(moves, begin, step, lambda acc: acc["peak"])


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of random-looking candidates that no allow-list entry and no base span covers."""
    allowed = "^(?:" + "|".join(f"(?:{p})" for p in ALLOW[:-1]) + ")$"
    fresh = F.filter(
        S.apart(S.find(text, CANDIDATE), base),
        lambda x: ~x["hit"].rlike(allowed) & ~x["hit"].rlike(f"^{ALLOW[-1]}$"),
    )
    is_hex = lambda hit: hit.rlike("^[0-9a-fA-F]+$")

    def random(kind: str, hit: Column) -> Column:
        mine, string = (is_hex(hit), F.lower(hit)) if kind == "entropy_hex" else (~is_hex(hit), hit)
        return mine & (peak_entropy(F.when(mine, string).otherwise(""), ALPHABET[kind]) >= BITS[kind])

    return S.together(*[
        S.of_kind(fresh, kind, len(BASE) + k, lambda hit, kind=kind: random(kind, hit)) for k, kind in enumerate(ALPHABET)
    ])


def found(docs: DataFrame) -> DataFrame:
    """doc_id, text, base (format spans) and added (entropy spans)."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.withColumn("base", format_spans(F.col("text")))
    return rows.withColumn("added", entropy_spans(F.col("text"), F.col("base")))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, base_sha256, n_entropy, spans."""
    base, added = F.col("base"), F.col("added")
    return found(docs).select(
        "doc_id", *[S.number(base, k).alias(f"n_{k}") for k in BASE], F.sha2(S.written(base), 256).alias("base_sha256"),
        F.size(added).cast("long").alias("n_entropy"), S.written(S.together(base, added)).alias("spans"),
    )


def without_secrets(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """The input's rows with every secret replaced by a mark; n_chars follows, null text stays null."""
    rows = packed(docs, "text").withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("_base", format_spans(F.col("_text")))
    rows = rows.withColumn("_added", entropy_spans(F.col("_text"), F.col("_base")))
    clean = S.masked(F.col("text"), S.together(F.col("_base"), F.col("_added")), lambda kind: F.lit(mark))
    return with_text(rows, docs.columns, clean)
