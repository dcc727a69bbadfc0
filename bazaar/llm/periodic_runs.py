"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a maximal stretch of words with smallest period q, at least ``max(LEAST, 2 q)`` words long.  Periods 2B-1 to
4B-2 belong to the scale of blocks of B words (1 to 6 to blocks of two words): the words that recur at distance q then
hold a whole aligned block.  All blocks of many texts are handled at once.  Of each block and the words that follow, the
sums of squared differences at all distances of the scale come from one convolution, computed exactly by a number
theoretic transform: words are labelled by integers small enough for the sums to stay under the prime, so a sum is 0
just if the labels are equal.  Blocks that follow each other at one distance make a chain; a chain is extended word by
word in both directions, by less than a block, which also rejects words that only share labels.

Distances that are multiples of the period of a run found at a smaller scale, within that run, lead to the same stretch
and are left out before the extension, so a text of one repeated word costs no more than any other.

Time is n log^2 n for n words; memory is a slab of transforms (``SLAB``) and a few arrays of the text's words.

Defined results: null, empty or blank text has 0 words and no run (nulls for the longest run, the hash of the empty
string for both digests); ties of the longest run go to the smallest start, then period; repeated rows and null
doc_ids are documents like any other and give one output row each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import WORD_BREAKS

LEAST = 12  # words of the shortest run
PRIME, ROOT, ORDER = 469762049, 3, 26  # 7 * 2^26 + 1, its least primitive root
SLAB = 1 << 17  # elements of the transforms handled at a time
GROUP = 1 << 16  # words of several texts handled at a time
_P = np.uint64(PRIME)


@cache
def _bit_reversed(size: int) -> np.ndarray:
    out = np.zeros(1, np.int64)
    while len(out) < size:
        out = np.concatenate([2 * out, 2 * out + 1])
    return out


@cache
def _twiddles(size: int) -> np.ndarray:
    """Square roots of the moduli's constants, in the order of the groups of a transform of ``size`` points."""
    root, powers = pow(ROOT, (PRIME - 1) // size, PRIME), np.ones(1, np.uint64)
    while len(powers) < size // 2:
        step = np.uint64(pow(root, len(powers), PRIME))
        powers = np.concatenate([powers, powers * step % _P])
    half = max(size // 2, 1)
    return powers[_bit_reversed(half)] if half > 1 else powers


def transform(a: np.ndarray) -> np.ndarray:
    """Values of each column's polynomial at the roots of unity, in bit-reversed order; rows must be a power of two.

    Each step takes remainders by x^h - c and x^h + c.  Only products are reduced, so a value grows by the prime a step.
    """
    size, columns = a.shape
    roots, groups = _twiddles(size), 1
    while groups < size:
        v = a.reshape(groups, 2, size // groups // 2, columns)
        low, high = v[:, 0], v[:, 1]
        if groups > 1:
            high = high * roots[:groups, None, None]
            high -= high // _P * _P
        out = np.empty_like(v)
        np.add(low, high, out=out[:, 0])
        np.subtract(low + _P, high, out=out[:, 1])
        a, groups = out, 2 * groups
    a = a.reshape(size, columns)
    return a - a // _P * _P


def correlations(blocks: np.ndarray, windows: np.ndarray, n: int) -> np.ndarray:
    """Sums of products of each block with the window's words from 0, 1, ... n-1 on (a column each); true integers as
    long as these are under the prime."""
    b, size = len(blocks), 4 * len(blocks)
    x = np.zeros((size, blocks.shape[1]), np.uint64)
    x[:b] = blocks[::-1]
    y = np.zeros_like(x)
    y[: len(windows)] = windows
    product = transform(x) * transform(y)
    order = _bit_reversed(size)
    back = transform((product - product // _P * _P)[order])
    got = back[order[(size - np.arange(b - 1, b - 1 + n)) % size]] * np.uint64(pow(size, -1, PRIME))
    return got - got // _P * _P


def _hits(ids: np.ndarray, base: np.ndarray, end: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and distances of the blocks of ``b`` words that recur at a distance of this scale (by label)."""
    low, high = (1, 6) if b == 2 else (2 * b - 1, 4 * b - 2)
    n = high - low + 1
    blocks = np.maximum((end - base - low) // b, 0)
    blocks[end - base < max(LEAST, 2 * low)] = 0
    first = np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = np.repeat(base, blocks) + (np.arange(blocks.sum()) - first) * b
    room = np.repeat(end, blocks) - start - b  # the greatest distance that stays in the text
    labels = np.zeros(len(ids) + 4 * b, np.uint64)
    labels[: len(ids)] = ids % isqrt((PRIME - 1) // (2 * b))
    squares = np.append(np.uint64(0), np.cumsum(labels * labels))
    at, found, step = [], [], max(1, SLAB // (4 * b))
    for i in range(0, len(start), step):
        s = start[i : i + step]
        dot = correlations(labels[s + np.arange(b)[:, None]], labels[s + np.arange(low, high + b)[:, None]], n)
        later = s + np.arange(low, high + 1)[:, None]
        differences = squares[later + b] - squares[later] + (squares[s + b] - squares[s]) - 2 * dot
        d, column = np.nonzero((differences == 0) & (np.arange(low, high + 1)[:, None] <= room[i : i + step]))
        at.append(s[column])
        found.append(d + low)
    return (np.concatenate(at), np.concatenate(found)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _reach(ids: np.ndarray, at: np.ndarray, d: np.ndarray, room: np.ndarray, sign: int) -> np.ndarray:
    """How many words on from ``at`` (or back) equal those ``d`` later, at most ``room``."""
    got, active, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    while len(active):
        stay = []
        for part in np.array_split(active, -(-len(active) * width // SLAB)):
            off = got[part, None] + np.arange(width)
            i = np.clip(at[part, None] + sign * off, 0, len(ids) - 1)
            same = (off < room[part, None]) & (ids[i] == ids[np.minimum(i + d[part, None], len(ids) - 1)])
            n = np.where(same.all(axis=1), width, same.argmin(axis=1))
            got[part] += n
            stay.append(part[n == width])
        active, width = np.concatenate(stay), min(2 * width, SLAB)
    return got


class Runs(NamedTuple):
    """Starts, ends (exclusive) and periods."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def find_runs(ids: np.ndarray, base: np.ndarray, end: np.ndarray) -> Runs:
    """All runs of texts whose words' ids lie one after another: text k is ``ids[base[k]:end[k]]``."""
    runs = Runs(*(np.zeros(0, np.int64) for _ in range(3)))
    longest, b = int((end - base).max(initial=0)), 2
    while longest >= LEAST and (b == 2 or 2 * (2 * b - 1) <= longest):
        at, d = _hits(ids, base, end, b)
        order = np.argsort(at, kind="stable")
        at, d = at[order], d[order]
        known = np.zeros(len(at), bool)
        for s, e, q in zip(*runs, strict=True):
            i, j = np.searchsorted(at, [s, e - b])
            known[i:j] |= (d[i:j] % q == 0) & (at[i:j] + d[i:j] + b <= e)
        at, d = at[~known], d[~known]
        order = np.lexsort((at, d))
        at, d = at[order], d[order]
        text = np.searchsorted(base, at, side="right") - 1
        fresh = np.ones(len(at), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (at[1:] != at[:-1] + b) | (text[1:] != text[:-1])
        first = np.flatnonzero(fresh)
        if len(first):
            last = np.append(first[1:], len(at)) - 1
            d, text, left, right = d[first], text[first], at[first], at[last] + b
            # labels may agree where words don't: a chain is walked from its first block on
            right = left + _reach(ids, left, d, end[text] - d - left, 1)
            left = left - _reach(ids, left - 1, d, left - base[text], -1)
            right = right + d
            enough = right - left >= np.maximum(LEAST, 2 * d)
            s, e, q = (np.concatenate([old, new[enough]]) for old, new in zip(runs, (left, right, d), strict=True))
            order = np.lexsort((q, e, s))
            s, e, q = s[order], e[order], q[order]
            least = np.ones(len(s), bool)  # one stretch has one smallest period
            least[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
            runs = Runs(s[least], e[least], q[least])
        b *= 2
    return runs


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string, n_words long, n_dropped long")


def _told(words: list[bytes], s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple:
    """The output of one text: its runs from its own first word on, by start, then period."""
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    lines = "".join(f"{a},{b - a},{p}\n" for a, b, p in zip(s.tolist(), e.tolist(), q.tolist(), strict=True))
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, s + q, 1)
    np.add.at(cover, e, -1)
    kept = np.cumsum(cover)[:-1] == 0
    text = b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k] if len(s) else words)
    best = (None,) * 4
    if len(s):
        k = int(np.lexsort((q, s, s - e))[0])
        n, p = int(e[k] - s[k]), int(q[k])
        best = (int(s[k]), n, p, 1000 * n // p)
    return len(s), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), len(words), int((~kept).sum())


def _of_texts(texts: list[list[bytes]]) -> list[tuple]:
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for words in texts for w in words], np.int64)
    end = np.cumsum([len(w) for w in texts])
    base = np.append(0, end[:-1])
    full = np.flatnonzero(end > base)
    runs = find_runs(ids, base[full], end[full])
    bounds = np.searchsorted(runs.start, np.append(base, len(ids)))
    return [_told(words, *(x[i:j] - shift * o for x, o in zip(runs, (1, 1, 0), strict=True)))
            for words, shift, i, j in zip(texts, base, bounds[:-1], bounds[1:], strict=True)]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in SCHEMA.split(", "))])
    for batch in batches:
        texts, rows, size = [], [], 0
        for text in batch.column(1).cast(pa.binary()):
            texts.append((text.as_py() or b"").split())  # bytes split at ASCII white space only
            size += len(texts[-1])
            if size >= GROUP:
                rows += _of_texts(texts)
                texts, size = [], 0
        rows += _of_texts(texts) if texts else []
        columns = [batch.column(0), *map(list, zip(*rows, strict=True))] if rows else [[] for _ in schema]
        yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def collapse(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, number of runs, the longest run, digests of all runs and of the collapsed text
    (words of a run after its first period dropped), numbers of words and of dropped words."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(_batches, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which one document of ten (by a hash of doc_id) repeats a stretch of its words to its end.

    With h = crc32 of the decimal doc_id, divisible by 10, g = h / 10 and n words, words from a = g mod n on repeat with
    the period 1 + (n - a) / (3 + g mod 8); the words are then joined by single spaces.  A null doc_id has no hash.
    """
    rows = docs.select(docs["doc_id"], docs["text"])
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = rows.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10)))
    words = F.when(F.col("_g").isNotNull(), F.filter(F.split("text", WORD_BREAKS), lambda w: w != ""))
    # steps of their own, so that words are cut once
    rows = rows.withColumn("_w", words).withColumn("_a", F.when(F.size("_w") > 0, F.col("_g") % F.size("_w")))
    rows = rows.withColumn("_p", 1 + F.floor((F.size("_w") - F.col("_a")) / (3 + F.col("_g") % 8)))

    def source(i: Column) -> Column:
        return F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))

    changed = F.transform("_w", lambda _, i: F.get("_w", source(i)))
    return rows.select("doc_id", F.when(F.col("_a").isNull(), F.col("text")).otherwise(F.array_join(changed, " ")).alias("text"))
