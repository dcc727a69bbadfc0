"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprint (one Arrow-batched pass over the text): lower-case A-Z, words, word shingles (repeats included), XXH64 of
each shingle with seed 42; a bit is one if it is set in over half of the hashes.

Links (at most ``max_bits`` differing bits): a fingerprint is eight (position, byte) terms.  ``max_bits`` bits can
spoil at most ``max_bits`` bytes, so linked fingerprints share at least ``8 - max_bits`` terms: the guaranteed count.
A posting list of a single term would hold 1/256 of all fingerprints, so the tally is taken on lists of that many
terms at once: a pair reaches the guaranteed count just if it meets in the list of some ``8 - max_bits`` positions.
Members of a list agree in all but ``max_bits`` bytes, so a list of distinct fingerprints is bounded by
``256 ** max_bits`` whatever the corpus is; copies meet once, as one fingerprint.  In each list the retained pairs
are verified by their bits, in a list too long for pairs by looking up each member's neighbours, and each
member is passed on with the least one that verified links reach: as many rows as members at most, none lost.
Components are found by distributed star contraction.

Defined results: null, empty or blank text has fingerprint zero and is linked like any other; rows without doc_id
take part, and ``component_id`` ignores their null id (null if a component has no other); repeated rows give one
output row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import ROW, cut, packed, unpacked
from bazaar.llm.components import components

SEED = 42
SLICE = 1 << 18  # shingles hashed at a time, so a very long text needs bounded memory


def fingerprint_of(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
        n = len(words) - shingle + 1
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for start in range(0, n, SLICE):
        size = min(SLICE, n - start)
        part = b"".join([digest(g, SEED) for g, _ in zip(grams, range(size), strict=False)] if n > SLICE
                        else [digest(g, SEED) for g in grams])
        ones += np.unpackbits(np.frombuffer(part, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(text: F.Column, shingle: int) -> F.Column:
    """Fingerprint column (the 64 bits as a signed long)."""

    @F.pandas_udf(T.LongType())
    def udf(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint_of(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return udf(text)


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Components of the links within one posting list of distinct fingerprints: each member with their least."""
    members = np.sort(members.view(np.uint64))
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if len(members) <= 512:
        left, right = np.triu_indices(len(members), 1)
        near = np.bitwise_count(members[left] ^ members[right]) <= max_bits
        pairs = [(left[near], right[near])]
    else:  # bounded by 256 ** max_bits members: look each neighbour up instead of comparing all pairs
        varied = int(np.bitwise_or.reduce(members ^ members[0]))
        bits = [1 << b for b in range(64) if varied >> b & 1]
        flips = [sum(c) for k in range(1, max_bits + 1) for c in combinations(bits, k)]
        pairs = []
        for flip in flips:
            other = members ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(members, other), len(members) - 1)
            hit = np.flatnonzero((members[at] == other) & (other > members))
            pairs.append((hit, at[hit]))
    for a, b in pairs:
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = root(i), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
    signed = members.view(np.int64)
    return [(int(signed[i]), int(signed[root(i)])) for i in range(len(members)) if root(i) != i]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Distinct fingerprints ``(fp)`` -> verified links ``(a, b)`` that connect whatever lies within ``max_bits``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must lie in 0..3")
    empty = "a long, b long"
    if max_bits == 0:
        return distinct.sparkSession.createDataFrame([], empty)
    masks = []
    for kept in combinations(range(8), 8 - max_bits):
        mask = sum(0xFF << 8 * p for p in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    lists = (
        distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("at", "term"))
        .groupBy("at", "term").agg(F.collect_set("fp").alias("members"))
        .where(F.size("members") > 1).select("members")
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [e for m in batch["members"] for e in _forest(np.asarray(m, np.int64), max_bits)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return lists.mapInPandas(verify, empty)


def classes(prints: DataFrame, max_bits: int, least: F.Column) -> DataFrame:
    """``prints(fp, ...)`` -> ``(fp, first)``: of every distinct fingerprint, the least value of its whole class."""
    spark = prints.sparkSession
    # fingerprints are few bytes, so adaptive execution would leave the wide step below to a few tasks
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = cut(prints.groupBy("fp").agg(F.min(least).alias("own")).repartition(spread))
    roots = cut(components(links(own.select("fp"), max_bits)))
    linked = cut(own.join(roots, own["fp"] == roots["node"]).select("fp", "root", "own"))
    of_root = linked.groupBy("root").agg(F.min("own").alias("first"))
    shared = linked.join(of_root, "root").select("fp", "first")
    return cut(own.join(shared, "fp", "left").select("fp", F.coalesce("first", "own").alias("first")))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable)."""
    prints = cut(docs.select(docs["doc_id"], fingerprints(docs["text"], shingle).alias("fp")))
    return prints.join(classes(prints, max_bits, F.col("doc_id")), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The input's rows without near-duplicates: of each class the row of least doc_id stays (null ids come last, a
    tie goes to the least text hash, and rows equal in both are one document)."""
    rows = packed(docs, "doc_id", "text").select(
        ROW, F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_hash"), "text",
    )
    key = ["_none", "_id", "_hash"]
    prints = cut(rows.select(*key, fingerprints(F.col("text"), shingle).alias("fp")))
    stay = classes(prints, max_bits, F.struct(*key)).select("first.*").distinct()
    return unpacked(rows.drop("text").join(stay, key, "left_semi").dropDuplicates(key))
