"""Phrase collocations: frequent phrases per language, counted by double-array tries and ranked by how their parts meet.

Texts are cut into pieces and words of bytes.  Level by level (words, pairs, triples):

1. **Candidates.**  A phrase can be frequent only if its parts are (Apriori).  Each task votes for the phrases it holds
   whose parts are in a bitmap of the frequent ones of the level below (hashed, of a bounded size; a false hit only
   costs a vote), each at most ``least`` times a chunk.  Phrases with ``least`` votes are the candidates; none that
   occurs so often is missed.
2. **Tries.**  Candidates are dealt by a hash of their first two words to shards of about ``SHARD`` bytes.  A task builds
   the double array of a shard (a phrase's bytes lead from slot to slot: the next slot is ``base[slot] + byte`` and
   ``check`` there names the slot before).  Shards are broadcast in waves of at most ``WAVE`` bytes (at least one shard).
3. **Counts.**  A word start can only begin phrases of the one shard that its two words are dealt to, so it walks that
   trie only, however many there are.  Starts of a chunk are dealt once; with several waves they are written beside the
   chunk, a column a wave, and a wave reads its own.  All starts of a shard walk at once: one numpy step a byte, those
   without a transition drop out; ends of phrases are counted by ``bincount``, and the tasks' counts are summed by Spark.

Scores compare a phrase's count with those of its two parts at the cut that scores lowest; products are exact decimals.
The ranking takes the first rows of salted parts of each language before those of the language.

Defined results: a null language is ``und``; null, empty or blank text has no word; words are bytes between breaks, so
any other character (also NUL) belongs to one; repeated rows and rows without doc_id count like any other; ties are
ranked by count, then by the phrase's bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import stored

UND = "und"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
CHUNK = 3 << 20  # bytes of text handled at a time
SHARD, WAVE = 8 << 20, 40 << 20  # bytes of a shard's phrases, of the arrays that are broadcast at a time
BITMAP = 27  # at most so many bits (as a power of two) tell frequent parts
END, SPACE = 10, 32  # no phrase holds a line feed: it marks where one ends
BLOCK = 4096  # phrases whose counts travel together
KEPT = 1 << 19  # words that a task counts before it hands them on
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Lines = Iterator[tuple[str, bytes]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Lines:
    """(lang, text): texts of one language joined, lower-cased, a line a piece, words one space apart."""
    held, size = defaultdict(list), Counter()

    def made(lang: str) -> tuple[str, bytes]:
        data = b"\n".join(held.pop(lang)).translate(LOWER)
        size.pop(lang)
        while b"  " in data:
            data = data.replace(b"  ", b" ")
        return lang, data.replace(b" \n", b"\n").replace(b"\n ", b"\n").strip(b" \n") + b"\n"

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
            if text.is_valid:
                lang, text = lang.as_py(), text.as_py()
                held[lang].append(text)
                size[lang] += len(text)
                if size[lang] >= CHUNK:
                    yield made(lang)
                elif size.total() >= 2 * CHUNK:
                    yield made(size.most_common(1)[0][0])
    for lang in list(held):
        yield made(lang)


def _over(docs: DataFrame, step: Callable[[Lines], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(UND)).alias("lang"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: step(_chunks(batches)), schema)


def _told(lang: str, columns: dict[str, object]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.record_batch({"lang": pa.array([lang] * n, pa.string()), **columns})


def _summed(rows: DataFrame) -> DataFrame:
    """Sums of n by lang and phrase.  Tasks send a phrase once a chunk, so rows are summed behind the shuffle only."""
    return rows.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ words

def _count_words(chunks: Lines) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def told(lang: str) -> pa.RecordBatch:
        c = counts.pop(lang)
        return _told(lang, {"phrase": pa.array(list(c), pa.binary()).cast(pa.string()), "n": pa.array(list(c.values()), pa.int64())})

    for lang, data in chunks:
        counts[lang].update(data.replace(b"\n", b" ").split(b" "))
        counts[lang].pop(b"", None)
        if sum(map(len, counts.values())) > KEPT:
            yield from [told(k) for k in list(counts)]
    yield from [told(k) for k in list(counts)]


def count_words(docs: DataFrame) -> DataFrame:
    """lang, phrase (a word), n: all occurrences."""
    return _summed(_over(docs, _count_words, "lang string, phrase string, n long"))


# ------------------------------------------------------------------ candidates

def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two phrases after each other."""
    x = a * _M1 + (b ^ (b >> np.uint64(29))) * _M2
    x ^= x >> np.uint64(32)
    x *= _M1
    return x ^ (x >> np.uint64(29))


def _hash(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


class Bitmap:
    """Which hashes are among the frequent phrases' (others may pass for one)."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap(phrases: DataFrame) -> Bitmap:
    """The bitmap of a table (lang, phrase): about 32 bits a phrase, at most 2^BITMAP in all."""
    bits = min(BITMAP, max(10, (32 * phrases.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.zeros(b.num_rows, np.uint64)
            for i, (lang, phrase) in enumerate(zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True)):
                parts = _hash(lang, phrase.split(b" "))
                h[i] = parts[0] if len(parts) == 1 else _joined(parts[:1], parts[1:2])[0]
            at = h >> np.uint64(64 - bits)
            bit = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.record_batch({"k": pa.array((at >> np.uint64(6)).astype(np.int64)), "w": pa.array(bit)})

    got = phrases.select("lang", "phrase").mapInArrow(places, "k long, w long").groupBy("k").agg(F.bit_or("w").alias("w"))
    got = got.toArrow()  # at most 2^(BITMAP - 6) rows
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[got["k"].to_numpy()] = got["w"].to_numpy().view(np.uint64)
    return Bitmap(bits, words)


def _votes(chunks: Lines, words: Bitmap, pairs: Bitmap | None, least: int) -> Iterator[pa.RecordBatch]:
    """Phrases of two words that are frequent, or of three whose pairs are, with their occurrences in a chunk."""
    for lang, data in chunks:
        known: dict[bytes, int] = {b"\n": 0}
        x = np.array([known.setdefault(w, len(known)) for w in data.replace(b"\n", b" \n ").split(b" ") if w], np.int64)
        vocabulary = list(known)
        h = _hash(lang, vocabulary)
        common = words.has(h)
        common[0] = False
        fine = common[x]
        fine = fine[:-1] & fine[1:]
        at = np.flatnonzero(fine)
        if pairs is not None:
            at = at[pairs.has(_joined(h[x[at]], h[x[at + 1]]))]
            at = at[:-1][at[1:] == at[:-1] + 1]
        size = np.int64(len(vocabulary))
        key = x[at] * size + x[at + 1]
        if pairs is None:
            key, n = np.unique(key, return_counts=True)
        else:
            key, pair = np.unique(key, return_inverse=True)
        parts = [key // size, key % size]
        if pairs is not None:
            both, n = np.unique(pair * size + x[at + 2], return_counts=True)
            parts = [p[both // size] for p in parts] + [both % size]
        table = pa.array(vocabulary, pa.binary()).cast(pa.string())
        for i in range(0, len(n), 1 << 20):
            phrase = pc.binary_join_element_wise(*[table.take(pa.array(p[i : i + (1 << 20)])) for p in parts], " ")
            yield _told(lang, {"phrase": phrase, "n": pa.array(np.minimum(n[i : i + (1 << 20)], least).astype(np.int32))})


def candidates(docs: DataFrame, words: Bitmap, pairs: Bitmap | None, least: int) -> DataFrame:
    """lang, phrase: pairs (or with ``pairs`` triples) that occur ``least`` times or more."""
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs))
    votes = _over(docs, lambda chunks: _votes(chunks, *shared.value, least), "lang string, phrase string, n int")
    return _summed(votes).where(F.col("n") >= least).select("lang", "phrase")


# ------------------------------------------------------------------ tries

def double_array(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base`` and ``check`` of sorted distinct phrases, and the code of each byte; where phrase i ends, base holds i.

    Bytes are coded by how often they begin a branch (0: never), so that the children of a node lie close together.
    Nodes with several children get a stretch of slots of their own; those with one child take slots left over.
    """
    lines = [p + bytes([END]) for p in phrases]
    flat = np.frombuffer(b"".join(lines), np.uint8)
    size = np.array([len(x) for x in lines])
    start = np.cumsum(size) - size
    node, parents, letters, total = np.zeros(len(lines), np.int64), [], [], 1
    ends = np.zeros(len(lines), np.int64)
    alive, depth = np.arange(len(lines)), 0
    while len(alive):
        b, up = flat[start[alive] + depth], node[alive]
        new = np.ones(len(alive), bool)
        new[1:] = (up[1:] != up[:-1]) | (b[1:] != b[:-1])
        parents.append(up[new])
        letters.append(b[new].astype(np.int64))
        node[alive] = total - 1 + np.cumsum(new)
        total += int(new.sum())
        depth += 1
        done = size[alive] == depth
        ends[alive[done]] = node[alive[done]]
        alive = alive[~done]
    # children of a node lie one after another; node 0 is the root
    up, letter = np.concatenate([np.zeros(0, np.int64), *parents]), np.concatenate([np.zeros(0, np.int64), *letters])
    seen = np.bincount(letter, minlength=256)
    code = np.zeros(256, np.uint8)
    order = np.argsort(-seen, kind="stable")[: np.count_nonzero(seen)]
    code[order] = np.arange(1, len(order) + 1)
    letter = code[letter].astype(np.int64)
    fresh = np.ones(len(up), bool)
    fresh[1:] = up[1:] != up[:-1]
    first = np.flatnonzero(fresh)
    owner, many = up[first], np.diff(np.append(first, len(up)))
    low, high = (f.reduceat(letter, first) if len(first) else letter for f in (np.minimum, np.maximum))
    at = np.zeros(total, np.int64)  # base by node
    wide = many > 1
    span = (high - low + 1)[wide]
    at[owner[wide]] = 256 + np.cumsum(span) - span - low[wide]
    slots = 256 + int(span.sum())
    taken = np.zeros(slots, bool)
    taken[at[up] + letter] = np.repeat(wide, many)
    free = np.flatnonzero(~taken[256:]) + 256
    need = int((~wide).sum())
    free = np.concatenate([free, np.arange(slots, slots + max(0, need - len(free)))])[:need]
    at[owner[~wide]] = free - low[~wide]
    slot = np.append(0, at[up] + letter)
    length = int(slot.max()) + 257
    base, check = np.zeros(length, np.int32), np.full(length, -1, np.int32)
    check[slot[1:]] = slot[up]
    base[slot] = at
    base[slot[ends]] = np.arange(len(lines))
    return base, check, code


def walk(data: np.ndarray, starts: np.ndarray, base: np.ndarray, check: np.ndarray, code: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of the phrases that begin at ``starts``, level by level."""
    inner = code.astype(np.int32)
    inner[END] = 0  # a walk goes on within a piece only
    at, state = starts, np.zeros(len(starts), np.int32)
    while len(at):
        row, letter = base[state], data[at]
        end = np.flatnonzero((letter == SPACE) | (letter == END))
        if len(end):
            last = row[end] + np.int32(code[END])
            yield base[last[check[last] == state[end]]]
        step = row + inner[letter]
        on = np.flatnonzero(check[step] == state)
        at, state = at[on] + 1, step[on]


def _pairs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words that another word of their piece follows, and a hash of the two.

    A word's hash is one of its first and last eight bytes and its length; it tells where to count, not what is equal.
    """
    gap = (data == SPACE) | (data == END)
    before = np.append(True, gap[:-1])
    start, end = np.flatnonzero(~gap & before).astype(np.int32), np.flatnonzero(gap & ~before).astype(np.int32)
    eight = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8)
    size = (end - start).astype(np.uint64)
    first = eight[start].view("<u8").ravel()
    short = size < 8
    first[short] &= (np.uint64(1) << (size[short] * np.uint64(8))) - np.uint64(1)
    last = np.where(short, first, eight[np.maximum(end - 8, 0)].view("<u8").ravel())
    word = _joined(first + size, last)
    two = np.flatnonzero(data[end[:-1]] == SPACE)
    return start[two], _joined(word[two], word[two + 1]) >> np.uint64(1)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases with the hash of their first two words."""
    for b in batches:
        lines = [p + bytes([END]) for p in b.column(1).cast(pa.binary()).to_pylist()]
        starts, h = _pairs(np.frombuffer(b"".join(lines), np.uint8))
        begin = np.cumsum([0, *map(len, lines)])[:-1]
        yield pa.record_batch({"lang": b.column(0), "phrase": b.column(1), "h": pa.array(h[np.searchsorted(starts, begin)].astype(np.int64))})


def _by_shard(data: np.ndarray, shards: int) -> list[np.ndarray]:
    """The starts that each shard's phrases can begin at."""
    starts, h = _pairs(data)
    shard = (h % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    return np.split(starts[order], np.searchsorted(shard[order], np.arange(1, shards)))


Wave = dict[str, list[int]]  # shards by language, in order


def _placed(chunks: Lines, shards: dict[str, int], waves: list[Wave]) -> Iterator[pa.RecordBatch]:
    """Chunks with their starts for each wave: how many of each of its shards, then these."""
    for lang, text in chunks:
        if lang in shards:
            starts = _by_shard(np.frombuffer(text, np.uint8), shards[lang])
            columns = {"text": pa.array([text], pa.binary())}
            for k, wave in enumerate(waves):
                own = [starts[s] for s in wave.get(lang, [])]
                part = np.concatenate([np.array([len(s) for s in own], np.int32), *own])
                columns[f"w{k}"] = pa.array([part.astype(np.int32).tobytes()], pa.binary())
            yield _told(lang, columns)


def _read(batches: Iterator[pa.RecordBatch], wave: Wave) -> Iterator[tuple[str, np.ndarray, dict[int, np.ndarray]]]:
    for batch in batches:
        for lang, text, part in zip(*batch.columns, strict=True):
            lang = lang.as_py()
            if lang in wave:
                part, n = np.frombuffer(part.as_py(), np.int32), len(wave[lang])
                yield lang, np.frombuffer(text.as_py(), np.uint8), dict(zip(wave[lang], np.split(part[n:], np.cumsum(part[: n - 1])), strict=True))


def _direct(chunks: Lines, shards: dict[str, int]) -> Iterator[tuple[str, np.ndarray, dict[int, np.ndarray]]]:
    for lang, text in chunks:
        if lang in shards:
            data = np.frombuffer(text, np.uint8)
            yield lang, data, dict(enumerate(_by_shard(data, shards[lang])))


def _count(located: Iterator[tuple[str, np.ndarray, dict[int, np.ndarray]]], tries: dict[str, list[tuple]]) -> Iterator[pa.RecordBatch]:
    counts = {(lang, shard): np.zeros(n, np.int64) for lang, shards in tries.items() for shard, n, *_ in shards}
    for lang, data, starts in located:
        for shard, n, *arrays in tries.get(lang, []):
            for found in walk(data, starts[shard], *arrays):
                counts[lang, shard] += np.bincount(found, minlength=n)
    for (lang, shard), seen in counts.items():
        blocks = [(b, seen[b : b + BLOCK]) for b in range(0, len(seen), BLOCK) if seen[b : b + BLOCK].any()]
        yield _told(lang, {"shard": pa.array([shard] * len(blocks), pa.int32()), "first": pa.array([b for b, _ in blocks], pa.int32()),
                           "counts": pa.array([c.tobytes() for _, c in blocks], pa.binary())})


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks that share a place; all of a place come to one task, one after another."""
    held: dict[tuple[str, int, int], np.ndarray] = {}
    for batch in batches:
        for lang, shard, first, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            seen = np.frombuffer(counts, np.int64)
            at = held.setdefault((lang, shard, first), np.zeros(len(seen), np.int64))
            at += seen
    for (lang, shard, first), seen in held.items():
        found = np.flatnonzero(seen)
        yield _told(lang, {"shard": pa.array(np.full(len(found), shard, np.int32)), "k": pa.array((found + first).astype(np.int32)), "n": pa.array(seen[found])})


def count_phrases(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, phrase, n: all occurrences of the given phrases (lang, phrase; of several words, distinct) in the texts."""
    spark = docs.sparkSession
    size = phrases.groupBy("lang").agg(F.sum(F.octet_length("phrase") + 1).alias("b"))
    size = size.select("lang", F.ceil(F.col("b") / SHARD).cast("int").alias("shards"))
    shards = {r["lang"]: r["shards"] for r in size.collect()}  # a row a language
    told = phrases.select("lang", "phrase").mapInArrow(_dealt, "lang string, phrase string, h long")
    share = told.join(F.broadcast(spark.createDataFrame(list(shards.items()), "lang string, shards int")), "lang")
    shard = F.pmod("h", "shards").cast("int")
    order = Window.partitionBy("lang", "shard").orderBy("phrase")  # about SHARD bytes
    dealt = stored(share.select("lang", "phrase", shard.alias("shard")).withColumn("k", F.row_number().over(order) - 1))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("k")
        base, check, code = double_array([p.encode() for p in part["phrase"]])
        return pd.DataFrame({"lang": part["lang"].iloc[:1], "shard": part["shard"].iloc[:1], "n": len(part), "bytes": base.nbytes + check.nbytes,
                             "base": [base.tobytes()], "check": [check.tobytes()], "code": [code.tobytes()]})

    built = stored(dealt.groupBy("lang", "shard").applyInPandas(build, "lang string, shard int, n int, bytes long, base binary, check binary, code binary"))
    waves: list[Wave] = []
    room = 0
    for row in built.select("lang", "shard", "bytes").orderBy("lang", "shard").collect():  # a row a shard
        if row["bytes"] > room:
            waves.append({})
            room = WAVE
        waves[-1].setdefault(row["lang"], []).append(row["shard"])
        room -= row["bytes"]
    kept = None
    if len(waves) > 1:
        kinds = ", ".join(f"w{k} binary" for k in range(len(waves)))
        # rows hold a chunk, so few of them are read at a time
        kept = stored(_over(docs, lambda chunks: _placed(chunks, shards, waves), f"lang string, text binary, {kinds}"), compression="zstd", **{"parquet.block.size": 4 * CHUNK})
    out = None
    for k, wave in enumerate(waves):
        chosen = spark.createDataFrame([(lang, s) for lang, own in wave.items() for s in own], "lang string, shard int")
        tries = defaultdict(list)
        for r in built.join(F.broadcast(chosen), ["lang", "shard"]).collect():  # at most WAVE bytes
            arrays = (np.frombuffer(r[c], t) for c, t in (("base", np.int32), ("check", np.int32), ("code", np.uint8)))
            tries[r["lang"]].append((r["shard"], r["n"], *arrays))
        shared = spark.sparkContext.broadcast(dict(tries))
        schema = "lang string, shard int, first int, counts binary"
        if kept is None:
            counts = _over(docs, lambda chunks, t=shared: _count(_direct(chunks, shards), t.value), schema)
        else:
            counts = kept.select("lang", "text", f"w{k}").mapInArrow(lambda rows, t=shared, w=wave: _count(_read(rows, w), t.value), schema)
        # rows are vectors, as many a task as the wave has blocks; a place's blocks are added up as they come
        counts = stored(counts.repartition("lang", "shard", "first").mapInArrow(_sum_blocks, "lang string, shard int, k int, n long"))
        shared.unpersist()
        out = counts if out is None else out.unionByName(counts)
    if out is None:
        return dealt.select("lang", "phrase", F.lit(0).cast("long").alias("n")).where(F.lit(False))
    return dealt.join(out, ["lang", "shard", "k"]).select("lang", "phrase", "n")


# ------------------------------------------------------------------ scores

def _score(a: Column, left: Column, right: Column) -> Column:
    wide = "decimal(19,0)"
    million_squares = (a.cast(wide) * a.cast(wide)).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", million_squares.cast("decimal(38,0)"), (left.cast(wide) * right.cast(wide)).cast("decimal(38,0)"))


def _cut_lowest(words: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score: the cut of least score, the first of equals."""
    def part(table: DataFrame, name: str) -> DataFrame:
        return table.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("n").alias(name))

    def joined(rows: DataFrame, table: DataFrame, text: str, name: str) -> DataFrame:
        p = part(table, name)
        return rows.join(p, (rows["lang"] == p["_l"]) & (rows[text] == p["_p"])).drop("_l", "_p")

    two = pairs.withColumn("_w1", F.substring_index("phrase", " ", 1)).withColumn("_w2", F.substring_index("phrase", " ", -1))
    two = joined(joined(two, words, "_w1", "l"), words, "_w2", "r")
    two = two.select("lang", "phrase", F.col("n").alias("a"), "l", "r", _score(F.col("n"), F.col("l"), F.col("r")).alias("score"))
    three = triples.withColumn("_w1", F.substring_index("phrase", " ", 1)).withColumn("_w3", F.substring_index("phrase", " ", -1))
    three = three.withColumn("_w12", F.substring_index("phrase", " ", 2)).withColumn("_w23", F.substring_index("phrase", " ", -2))
    for table, text, name in ((words, "_w1", "l1"), (pairs, "_w23", "r1"), (pairs, "_w12", "l2"), (words, "_w3", "r2")):
        three = joined(three, table, text, name)
    three = three.withColumns({f"s{k}": _score(F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)})
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", F.col("n").alias("a"),
                         *[F.when(first, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(o) for c, o in (("l", "l"), ("r", "r"), ("s", "score"))])
    return two.unionByName(three)


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, cover: int = 50) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words: lang, rank, phrase, a, l, r, n, score.

    Phrases occur ``least`` times or more; one goes if a longer one that holds it has ``cover`` percent of its count.
    """
    words = stored(count_words(docs))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.where(F.col("n") >= least)
    ones = bitmap(words)
    twos = stored(candidates(docs, ones, None, least))
    threes = stored(candidates(docs, ones, bitmap(twos), least))
    counted = stored(count_phrases(docs, twos.unionByName(threes)))
    inner = F.length(F.translate("phrase", " ", "")) == F.length("phrase") - 1  # two words
    pairs, triples = counted.where(inner), counted.where(~inner)
    scored = _cut_lowest(words, pairs, triples)
    held = triples.select("lang", F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase"), "n")
    held = held.groupBy("lang", "phrase").agg(F.max("n").alias("_most"))
    scored = scored.join(held, ["lang", "phrase"], "left").where(F.col("_most").isNull() | (100 * F.col("_most") < cover * F.col("a"))).drop("_most")
    # the first rows of salted parts, then of the language: no task ranks a whole language
    salt = max(1, ceil(counted.count() / 200_000))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    few = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salt)))
    few = few.withColumn("_k", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).where(F.col("_k") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
