"""Quality rules with host verdicts.

Per document (one Arrow-batched pass): word and symbol counts, repeated lines, words inside repeated three-word
windows; from these the rules.  Per host (``source``): failures of each rule are summed, the rates are shrunk with a
beta prior fitted to all hosts' rates by moments, and a host fails a rule if its shrunk rate is over ``limit``.  The
verdicts are joined back: a document goes if it fails a base rule, or if it fails a rule that its host fails as well;
so clean documents of a bad host stay, and a single odd document of a good host does too.

Defined results: null, empty or blank text has no words (all counts 0) and fails the base rule on length; a document
without source has no host verdict; a tie with a limit passes; repeated rows give one output row each and each counts
for the host; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import cut

# Characters counted as symbols and as white space.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"

#: Rules over the counts: true where a document fails.  The first two are the base rules.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_size": "word_chars > 12 * n_words OR word_chars < 2 * n_words",
}
BASE = ("short", "repeats")


def _repeat_words(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    grams = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ h[2:]
    order = np.argsort(grams, kind="stable")
    same = np.diff(grams[order]) == 0
    if not same.any():
        return 0
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def counts_of(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, lines with a word, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    seen: set[str] = set()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    seen.update(lines)
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines),
        len(lines) - len(seen), _repeat_words(words),
    )


def counts(text: Column) -> Column:
    @F.pandas_udf(COUNTS)
    def udf(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in COUNTS.split(", ")]
        return pd.DataFrame([counts_of(t) for t in texts], columns=names, dtype="int64")

    return udf(text)


def rule_failures(docs: DataFrame) -> DataFrame:
    """doc_id, host, the counts and a struct ``fails`` of one boolean per rule."""
    rows = docs.select(docs["doc_id"], docs["source"].cast("string").alias("host"), counts(docs["text"]).alias("c"))
    rows = rows.select("doc_id", "host", "c.*")
    return rows.withColumn("fails", F.struct(*[F.expr(sql).alias(name) for name, sql in RULES.items()]))


def host_rates(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """host, n_docs, shrunk rate of each rule (``rates``) and whether the host fails it (``bad``)."""
    hosts = cut(
        rows.where(F.col("host").isNotNull()).groupBy("host").agg(
            F.count("*").alias("n_docs"),
            *[F.sum(F.col(f"fails.{r}").cast("long")).alias(f"n_{r}") for r in RULES],
        )
    )
    # prior of each rule by moments over hosts: a fixed number of figures, whatever the number of hosts
    seen = hosts.agg(
        *[f(F.col(f"n_{r}") / F.col("n_docs")).alias(f"{k}_{r}") for r in RULES for k, f in (("m", F.avg), ("v", F.var_pop))]
    ).first()
    rates = []
    for r in RULES:
        m, v = seen[f"m_{r}"] or 0.0, seen[f"v_{r}"] or 0.0
        m = min(max(m, 1e-6), 1 - 1e-6)
        strength = min(max(m * (1 - m) / v - 1, 2.0), 1000.0) if v > 0 else 1000.0
        rates.append(((F.col(f"n_{r}") + m * strength) / (F.col("n_docs") + strength)).alias(r))
    shrunk = hosts.select("host", "n_docs", F.struct(*rates).alias("rates"))
    return shrunk.withColumn("bad", F.struct(*[(F.col(f"rates.{r}") > limit).alias(r) for r in RULES]))


def verdicts(docs: DataFrame, limit: float = 0.5) -> DataFrame:
    """One row per document: the counts, base_failed, the host's verdict and kept."""
    rows = cut(rule_failures(docs))
    hosts = cut(host_rates(rows, limit))
    both = rows.join(hosts, "host", "left")
    base = F.col("fails")[BASE[0]] | F.col("fails")[BASE[1]]
    by_host = F.lit(False)
    for r in RULES:
        by_host = by_host | (F.col(f"fails.{r}") & F.coalesce(F.col(f"bad.{r}"), F.lit(False)))
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        by_host.alias("host_failed"), (~base & ~by_host).alias("kept"),
    )
