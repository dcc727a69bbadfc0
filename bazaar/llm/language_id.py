"""Language identification by multilingual mixture inference.

Model: letter trigrams inside words (case folded, hashed to ``BUCKETS``), counted per language over labelled rows and
smoothed; it is fitted on at most about ``per_lang`` documents of each language, picked by a hash of doc_id.

Inference per document: every word has a likelihood under each language, the product of its trigrams'.
Expectation-maximisation estimates the document's language proportions from these; the language set is the one of
least penalised likelihood (-2 log L + (k - 1) log words) on the path of languages in order of their proportions.  The
prediction is the language of the greatest share and ``score`` is this share.

One Arrow-batched pass: words of many documents are handled in one array, a very long text in slices.

Defined results: null or letterless text, or nothing to learn from, gives ``und`` with score 0; ties go to the first
language by name; a null doc_id is neither learnt from nor held out; repeated rows give one output row each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import packed, unpacked

BUCKETS = 1 << 16
SLICE = 1 << 20  # characters of one text handled at a time
GROUP = 1 << 20  # letters of many texts handled at a time
FLOOR = 1e-6  # no word counts for more than this against a language
ROUNDS, STEP = 40, 1e-4
UND = "und"
HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, false)"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Trigram bucket of every letter (with its neighbours in the word), and where each word begins among these."""
    cp = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    cp = np.where(letter, cp, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    mixed = cp[at - 1] * np.uint64(0x9E3779B97F4A7C15) + cp[at] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed + cp[np.minimum(at + 1, len(cp) - 1)] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(48)).astype(np.int64), np.flatnonzero(~letter[at - 1])


def _slices(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SLICE:
        end = text.rfind(" ", start, start + SLICE)
        end = end if end > start else start + SLICE
        yield text[start:end]
        start = end
    yield text[start:]


def fit(docs: DataFrame, per_lang: int = 2000) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each (bucket, language), from the labelled rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~F.expr(HELD_OUT)
    )
    share = {r["lang"]: min(1.0, per_lang / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(share)
    if not langs:
        return [], np.zeros((BUCKETS, 0))
    pairs = [F.lit(x) for lang in langs for x in (lang, round(share[lang] * 1_000_000))]
    picked = rows.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_000)) < F.create_map(*pairs)[F.col("lang")])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                seen = np.zeros(BUCKETS, np.int64)
                for text in texts:
                    for part in _slices(text):
                        seen += np.bincount(_grams(part)[0], minlength=BUCKETS)
                found = np.flatnonzero(seen)
                yield pd.DataFrame({"lang": lang, "bucket": found, "n": seen[found]})

    counts = np.zeros((BUCKETS, len(langs)))
    table = picked.select("lang", "text").mapInPandas(count, "lang string, bucket long, n long")
    got = table.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS rows a language
    counts[got["bucket"], got["lang"].map({x: i for i, x in enumerate(langs)})] = got["n"]
    counts += 0.5
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _share(like: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over documents whose words lie one after another: proportions and log likelihood of each.

    like: words x languages; first: index of each document's first word; allowed: documents x languages.
    """
    n = np.diff(np.append(first, len(like)))
    owner = np.repeat(np.arange(len(first)), n)
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = like * pi[owner]
        part /= part.sum(axis=1, keepdims=True)
        new = np.add.reduceat(part, first, axis=0) / n[:, None]
        moved = np.abs(new - pi).max()
        pi = new
        if moved < STEP:
            break
    return pi, np.add.reduceat(np.log((like * pi[owner]).sum(axis=1)), first)


def _mixtures(logs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language of each document and its share in the chosen mixture."""
    n = np.diff(np.append(first, len(logs)))
    like = np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), FLOOR).astype(np.float64)
    single = np.add.reduceat(np.log(like), first, axis=0)
    best, score = single.argmax(axis=1), np.ones(len(first))
    cost = -2 * single.max(axis=1)
    if logs.shape[1] == 1:
        return best, score
    full, top = _share(like, first, np.ones((len(first), logs.shape[1])))
    # a mixture of any set is no likelier than the full one: only where that beats one language are sets compared
    open_ = np.flatnonzero(-2 * top + np.log(n) < cost)
    if len(open_):
        words = np.concatenate([np.arange(first[d], first[d] + n[d]) for d in open_])
        sub, start = like[words], np.append(0, np.cumsum(n[open_])[:-1])
        rank = np.argsort(np.argsort(-full[open_], axis=1, kind="stable"), axis=1)
        for k in range(2, logs.shape[1] + 1):
            pi, ll = _share(sub, start, (rank < k).astype(np.float64))
            price = -2 * ll + (k - 1) * np.log(n[open_])
            better = price < cost[open_]
            d = open_[better]
            cost[d], best[d], score[d] = price[better], pi[better].argmax(axis=1), pi[better].max(axis=1)
    return best, score


def predict(texts: pd.Series, langs: list[str], logp: np.ndarray) -> pd.DataFrame:
    """Language and share for a series of texts."""
    lang, score = np.full(len(texts), UND, object), np.zeros(len(texts))
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if held:
            sizes = np.array([len(x) for _, x in held])
            best, share = _mixtures(np.concatenate([x for _, x in held]), np.append(0, np.cumsum(sizes)[:-1]))
            rows = np.array([i for i, _ in held])
            lang[rows], score[rows] = np.array(langs, object)[best], np.clip(share, 0, 1)
            held.clear()

    letters = 0
    for i, text in enumerate(texts):
        if text is None or not langs:
            continue
        words = []
        for part in _slices(text):
            grams, first = _grams(part)
            if len(grams):
                first = first if len(first) and first[0] == 0 else np.append(0, first)
                words.append(np.add.reduceat(logp[grams], first, axis=0))
                letters += len(grams)
        if words:
            held.append((i, np.concatenate(words)))
        if letters >= GROUP:
            flush()
            letters = 0
    flush()
    return pd.DataFrame({"lang": lang, "score": score})


def language(text: Column, model: tuple[list[str], np.ndarray]) -> Column:
    """Struct (lang, score) of a text column."""
    langs, logp = model

    @F.pandas_udf("lang string, score double")
    def udf(texts: pd.Series) -> pd.DataFrame:
        return predict(texts, langs, logp)

    return udf(text)


def identify(docs: DataFrame, per_lang: int = 2000) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    found = docs.select(docs["doc_id"], language(docs["text"], fit(docs, per_lang)).alias("found"))
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score")


def known_language(docs: DataFrame, min_score: float = 0.5, per_lang: int = 2000) -> DataFrame:
    """The rows whose text has a language with a share of ``min_score`` or more; ``und`` goes."""
    rows = packed(docs, "text").withColumn("_found", language(F.col("text"), fit(docs, per_lang)))
    return unpacked(rows.where((F.col("_found.lang") != UND) & (F.col("_found.score") >= min_score)))
