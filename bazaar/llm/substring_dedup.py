"""Substring dedup by level-wise doubling: word windows repeated at one length alone are extended to twice that length.

Lengths start at about half of ``window`` (``start``), double, and end at ``window``, the length that removal is
defined on; a longer repeat is a run of such windows.  At a length below ``window`` not every position has to be
looked at: of each ``window``-word window only its least-hashed subwindow of that length counts, and equal windows
have equal ones.  So a first pass sends a tenth of all positions through one shuffle, texts without a repeated
subwindow drop out, and the next length only looks at windows that hold a repeated one.

A shuffled row is (hash, text, position).  Positions of one hash within a batch are decided there and only one of them
represents the batch, so a passage that a third of all documents share sends one row per batch, not one per document,
to the task of its hash.  Texts are told apart, and windows compared, by 64-bit hashes.  Copies of a text are handled
once: every window of a copied text also starts in the copy.

Windows are judged on the input as it is; every document is judged, the first copy too.

Defined results: null, empty or blank text has 0 words and keeps the empty string; a text of fewer words than
``window`` keeps all; repeated rows and null doc_ids are documents like any other and give one output row each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import cut, stored

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
ROWS = "h long, k long, pos int, decided boolean"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _M1 + (b ^ (b >> np.uint64(29))) * _M2
    x ^= x >> np.uint64(32)
    x *= _M1
    return x ^ (x >> np.uint64(29))


def _hashes(words: list[bytes], *lengths: int) -> list[np.ndarray]:
    """Hashes of all windows of each length, built by doubling from those of single words."""
    digest = xxhash.xxh64_digest
    by = {1: np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)}
    out = []
    for length in lengths:
        p = 1
        while p * 2 <= length:
            if p * 2 not in by:
                by[p * 2] = _pair(by[p][: len(words) - 2 * p + 1], by[p][p:])
            p *= 2
        h = by[p]
        if p < length:
            h = _pair(h[: len(words) - length + 1], h[length - p :])
        out.append(h)
    return out


def _sliding(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """Least or greatest of every run of ``size`` values, by doubling."""
    p, out = 1, values
    while p * 2 <= size:
        out = best(out[: len(out) - p], out[p:])
        p *= 2
    if p < size:
        out = best(out[: len(values) - size + 1], out[size - p :])
    return out


def _held(repeated: np.ndarray, h: np.ndarray, least: np.ndarray, window: int, length: int) -> np.ndarray:
    """Which windows have their least-hashed subwindow among the repeated positions."""
    marked = np.full(len(h), _TOP)
    marked[repeated] = h[repeated]
    return _sliding(marked, window - length + 1, np.minimum) == least


def _positions(words: list[bytes], window: int, length: int, before: int, repeated) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) rows of one text at a length; ``repeated``: positions found at the length before it."""
    hashes = _hashes(words, length, before) if before else _hashes(words, length)
    h, n = hashes[0], len(words) - window + 1
    if before:
        low = _sliding(hashes[1], window - before + 1, np.minimum)
        live = _held(np.asarray(repeated, np.int64), hashes[1], low, window, before)
    else:
        live = np.ones(n, bool)
    if length == window:
        at = np.flatnonzero(live)
        return h[at], at
    size = window - length + 1
    low = np.where(live, _sliding(h, size, np.minimum), np.uint64(0))
    edge = np.zeros(size - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), size, np.maximum) == h)
    return h[at], at


def _rows(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Rows of a batch: a hash met again in the batch is decided here and represented once."""
    if not found:
        return pd.DataFrame({"h": [], "k": [], "pos": [], "decided": []}).astype({"h": "int64", "k": "int64", "pos": "int32", "decided": bool})
    h = np.concatenate([x for _, x, _ in found])
    k = np.repeat(np.array([x for x, _, _ in found], np.int64), [len(x) for _, x, _ in found])
    pos = np.concatenate([x for _, _, x in found])
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    last = np.append(new[1:], True)
    again, first = np.empty(len(h), bool), np.empty(len(h), bool)
    again[order], first[order] = ~(new & last), new
    # those that represent nothing get a key of their own, so that they spread
    key = np.where(first, h, _pair(k.view(np.uint64), pos.astype(np.uint64)))
    return pd.DataFrame({"h": key.view(np.int64), "k": k, "pos": pos.astype(np.int32), "decided": again})


def _level(texts: DataFrame, window: int, length: int, before: int) -> DataFrame:
    """``texts(k, text[, repeated])`` -> (k, repeated): positions of the windows of ``length`` that are repeated."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, seen = [], set()
            for i, (k, text) in enumerate(zip(batch["k"].tolist(), batch["text"], strict=True)):
                words = words_of(text)
                if len(words) < window or k in seen:
                    continue
                seen.add(k)
                h, at = _positions(words, window, length, before, batch["repeated"].iloc[i] if before else None)
                found.append((k, h, at))
            yield _rows(found)

    rows = texts.mapInPandas(look, ROWS)
    counted = rows.withColumn("n", F.count("*").over(Window.partitionBy("h")))
    return counted.where("decided OR n > 1").groupBy("k").agg(F.collect_list("pos").alias("repeated"))


def lengths(window: int, start: int | None = None) -> list[int]:
    """Window lengths of the levels."""
    length = start or (window + 1) // 2
    out = []
    while length < window:
        out.append(length)
        length *= 2
    return [*out, window]


def without(words: list[bytes], window: int, starts) -> tuple[int, list[bytes]]:
    """Number of words under the windows that start at the given positions, and the words left."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.asarray(starts, np.int64), 1)
    np.add.at(edge, np.asarray(starts, np.int64) + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return int(gone.sum()), [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def repeated_windows(docs: DataFrame, window: int = 35, start: int | None = None) -> DataFrame:
    """(k, text, starts) of each text, known by its hash k, that has windows repeated in itself or another text."""
    keyed = docs.select(F.xxhash64("text").alias("k"), "text")
    texts, before = keyed, 0
    for length in lengths(window, start):
        survivors = _level(texts, window, length, before)
        if before == 0:
            # copies meet in the map-side aggregation, so a text is shuffled once a task
            texts = keyed.groupBy("k").agg(F.first("text").alias("text"))
        texts = stored(texts.drop("repeated").join(survivors, "k"))
        before = length
    return texts.withColumnRenamed("repeated", "starts")


def dedup(docs: DataFrame, window: int = 35, start: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))

    @F.pandas_udf("n_words long, sha string")
    def facts(texts: pd.Series) -> pd.DataFrame:
        split = [words_of(t) for t in texts]
        return pd.DataFrame({"n_words": [len(w) for w in split], "sha": [_sha(w) for w in split]}).astype({"n_words": "int64", "sha": object})

    @F.pandas_udf("n_removed long, kept string")
    def removed(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        got = [without(words_of(t), window, s) for t, s in zip(texts, starts, strict=True)]
        return pd.DataFrame({"n_removed": [n for n, _ in got], "kept": [_sha(w) for _, w in got]}).astype({"n_removed": "int64", "kept": object})

    known = cut(rows.select("doc_id", F.xxhash64("text").alias("k"), facts("text").alias("f")).select("doc_id", "k", "f.*"))
    found = repeated_windows(rows, window, start).select("k", removed("text", "starts").alias("r")).select("k", "r.*")
    copied = known.where(F.col("n_words") >= window).groupBy("k").agg(F.count("*").alias("copies"), F.first("n_words").alias("all"))
    whole = copied.where("copies > 1").select("k", F.col("all").alias("n_removed"), F.lit(_sha([])).alias("kept"))
    outcome = cut(found.join(whole, "k", "left_anti").unionByName(whole))
    return known.join(outcome, "k", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256")
    )
