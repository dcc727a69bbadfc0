"""Spans of regular expressions in text, as native column expressions.

A span is a struct (start, end, kind, rank, hit): code points, end exclusive; ``rank`` orders the kinds.  Positions
come from cutting the text at the matches: what lies between matches and the matches themselves take turns, so their
lengths add up to the offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

HITS = "array<struct<start:int,end:int,hit:string>>"
SPANS = "array<struct<start:int,rank:int,kind:string,end:int,hit:string>>"


def find(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, hit)."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    turns = F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        new = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(new)).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(HITS).alias("out"))
    found = F.aggregate(F.filter(turns, lambda x: x["hit"].isNotNull()), begin, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(HITS))


def of_kind(hits: Column, kind: str, rank: int, holds: Callable[[Column], Column] | None = None) -> Column:
    """Hits that hold, as spans of a kind."""
    kept = hits if holds is None else F.filter(hits, lambda x: holds(x["hit"]))
    return F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["hit"].alias("hit"),
    )).cast(SPANS)


def together(*spans: Column) -> Column:
    """One array of spans by start, then rank."""
    return F.array_sort(F.concat(*spans))


def by_kind(spans: Column) -> Column:
    """Spans by rank, then start."""
    moved = F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s.alias("s"))))
    return F.transform(moved, lambda m: m["s"])


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def apart(spans: Column, others: Column) -> Column:
    """Spans that touch no span of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (o["end"] > s["start"])))


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with each span replaced by a mark; overlapping spans become the first one's mark."""

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(new, F.concat(acc["out"], gap, mark(s["kind"]))).otherwise(acc["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
