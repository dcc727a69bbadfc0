"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads each position once and its output links give every piece that ends there; each such piece relaxes
the best path at its end from the best path at its start.

* ``unigram`` vocabularies: a path's score is the sum of its pieces' scores.
* ``bpe`` vocabularies: scores are merge ranks, not log probabilities, and their sum would not give the model's ids.
  Here a step is admissible if the merges leave the last piece of the path and the new piece as they are; a path of
  admissible steps is the merge result, so one path at each position survives and the ids equal those of the merges.
  Equal ranks (runs of spaces) make the order of merges matter, so such a run is merged directly.

Characters that no piece holds go by their UTF-8 bytes.  No piece crosses from a letter into a space, so texts are
encoded unit by unit and each distinct unit once for a (bounded) cache.  A literal U+2581, which marks spaces inside
the pieces, goes by its bytes too: decoding then gives back every text exactly.

Defined results: null text gives null ids, 0 tokens and a null round trip; empty text gives no ids; repeated rows give
one output row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import string
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
CACHE = 200_000  # units kept by a worker in each of two generations
LONG_UNIT = 64  # longer units are encoded but not kept
SLICE = 256  # rows put together at a time


class Pieces:
    """A piece vocabulary with its automaton."""

    def __init__(self, model: bytes, kind: str):
        if kind not in ("bpe", "unigram"):
            raise ValueError("kind is 'bpe' or 'unigram'")
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.bytes_id = [0] * 256
        self.raw: list[bytes] = [b""] * size  # what each id decodes to
        self.ids: dict[str, int] = {}
        self.score: list[float] = [0.0] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            self.score[i] = sp.get_score(i)
            if sp.is_byte(i):
                self.bytes_id[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.raw[i] = piece.replace(MARK, " ").encode()
        self.text = {i: p for p, i in self.ids.items()}
        self.bpe = kind == "bpe"
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        # where units may be cut: white space that no piece holds, a space mark after anything but itself, and a symbol
        # after a character that comes before no symbol in any piece
        pairs = {(x, y) for p in self.ids for x, y in zip(p, p[1:], strict=False)}
        self.whole = any(y == MARK != x for x, y in pairs)
        blanks = "".join(c for c in "\n\t" if not any(c in p for p in self.ids))
        symbols = {c for c in string.punctuation}
        others = symbols | {x for x, y in pairs if y in symbols} - {MARK}
        end, s, o = MARK + blanks, re.escape("".join(sorted(symbols))), re.escape("".join(sorted(others)))
        blank = f"[{blanks}]|" if blanks else ""
        self.units = re.compile(f"{blank}{MARK}*[^{end}{o}]+(?=[{s}{end}]|$)|{MARK}*[^{end}]+|{MARK}+")
        self.admitted: dict[int, dict[int, bool]] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.prefix = MARK if sp.encode("a", out_type=str)[0].startswith(MARK) else ""

    def merged(self, unit: str) -> list[int]:
        """Ids by the merges themselves: the adjacent pair of best score first, the leftmost of equals."""
        parts: list[str | None] = list(unit)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.ids:
                    heapq.heappush(queue, (-self.score[self.ids[both]], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        out: list[int] = []
        for p in parts:
            if p is not None:
                out.extend([self.ids[p]] if p in self.ids else self.as_bytes(p))
        return out

    def as_bytes(self, text: str) -> list[int]:
        return [self.bytes_id[b] for b in text.encode("utf-8", "surrogatepass")]

    def admits(self, last: int, piece: int) -> bool:
        """Whether the merges leave ``last`` followed by ``piece`` as they are (last -1: the path begins here)."""
        want = [piece] if last < 0 else [last, piece]
        return self.merged("".join(self.text[i] for i in want)) == want

    def viterbi(self, unit: str) -> list[int]:
        n = len(unit)
        last = [-2] * (n + 1)  # id of the best path's last piece; -1: path begins here; -2: not reached
        start = [0] * (n + 1)
        best = [0.0] * (n + 1)
        last[0] = -1
        filled = 0

        def bridge(upto: int) -> int:
            """Ends that no piece reaches: the character before goes by its bytes and the path begins anew."""
            for e in range(filled + 1, upto + 1):
                if last[e] == -2:
                    last[e], start[e], best[e] = -1, e - 1, best[e - 1]
            return upto

        bpe, score, admitted = self.bpe, self.score, self.admitted
        after: list[dict[int, bool]] = [admitted.setdefault(-1, {})] * (n + 1)  # pieces known to follow the best path
        for end, (piece, size) in self.automaton.iter(unit):
            if filled < end:
                filled = bridge(end)
            e = end + 1
            s = e - size
            if bpe:
                if last[e] == -2:
                    ok = after[s].get(piece)
                    if ok is None:
                        ok = after[s][piece] = self.admits(last[s], piece)
                    if ok:
                        last[e], start[e], after[e] = piece, s, admitted.setdefault(piece, {})
            elif last[e] == -2 or best[s] + score[piece] > best[e]:
                last[e], start[e], best[e] = piece, s, best[s] + score[piece]
        bridge(n)
        out: list[int] = []
        e = n
        while e:  # backwards, so bytes of a character are put in reverse
            if last[e] >= 0:
                out.append(last[e])
            else:
                out.extend(reversed(self.as_bytes(unit[start[e] : e])))
            e = start[e]
        out.reverse()
        return out

    def unit_ids(self, unit: str) -> bytes:
        """Ids of a unit as the bytes of 32-bit numbers; units met again are kept longest."""
        known = self.young.get(unit) or self.old.get(unit)
        if known is None:
            run = self.bpe and unit.startswith(MARK * 2)
            known = array("i", self.merged(unit) if run else self.viterbi(unit)).tobytes()
        if len(unit) <= LONG_UNIT:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[unit] = known
        return known

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        out: list[bytes] = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out.append(array("i", self.as_bytes(MARK)).tobytes())
            spaced = ("" if i else self.prefix) + part.replace(" ", MARK)
            units = ([spaced] if spaced else []) if self.whole else self.units.findall(spaced)
            known = list(map(self.young.get, units))
            if None in known:
                known = [k or self.unit_ids(u) for k, u in zip(known, units, strict=True)]
            out.extend(known)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[len(self.prefix) :] if self.prefix and text.startswith(" ") else text


@cache
def _pieces(model: bytes, kind: str) -> Pieces:
    return Pieces(model, kind)


def load(path: str) -> bytes:
    """The model file, read on the driver; its bytes travel with the job, so executors need no file."""
    with open(path, "rb") as f:
        return f.read()


def encoded(rows: DataFrame, model: bytes, kind: str) -> DataFrame:
    """``rows(..., text)`` with ``_ids`` and ``_exact`` (whether decoding gives the text back) beside all columns.

    Ids are put together in Arrow buffers, ``SLICE`` rows at a time.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(model, kind)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column("text").to_pylist()
                found = [p.encode(t or "") for t in texts]
                exact = pa.array([None if t is None else p.decode(i.tolist()) == t for t, i in zip(texts, found, strict=True)], pa.bool_())
                ends = np.cumsum([len(i) for i in found])
                null = np.array([t is None for t in texts] + [False])
                offsets = pa.array(np.append(0, ends).astype(np.int32), mask=null)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, exact], names=[*part.schema.names, "_ids", "_exact"])

    schema = T.StructType([*rows.schema.fields, T.StructField("_ids", T.ArrayType(T.IntegerType())), T.StructField("_exact", T.BooleanType())])
    return rows.mapInArrow(encode, schema)


def decoded(ids: Column, model: bytes, kind: str) -> Column:
    """Text of an ids column; null stays null."""

    @F.pandas_udf(T.StringType())
    def udf(rows: pd.Series) -> pd.Series:
        p = _pieces(model, kind)
        return pd.Series([None if r is None else p.decode(list(r)) for r in rows], dtype=object)

    return udf(ids)


def _counted() -> Column:
    return F.when(F.col("_ids").isNull(), 0).otherwise(F.size("_ids")).cast("long")


def tokens(docs: DataFrame, model_path: str, kind: str = "bpe") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, round_trip."""
    got = encoded(docs.select(docs["doc_id"], docs["text"]), load(model_path), kind)
    return got.select("doc_id", _counted().alias("n_tokens"), F.col("_ids").alias("ids"), F.col("_exact").alias("round_trip"))


def tokenised(docs: DataFrame, model_path: str, kind: str = "bpe") -> DataFrame:
    """The input's rows with n_tokens, token_ids and round_trip, which replace columns of these names."""
    new = {"n_tokens": _counted(), "token_ids": F.col("_ids"), "round_trip": F.col("_exact")}
    rows = docs.drop(*new, "_ids", "_exact")
    return encoded(rows, load(model_path), kind).withColumns(new).select(*rows.columns, *new)
