"""Document fingerprints: SimHash of weighted terms, and permuted block tables for the search by Hamming radius.

Terms are pairs of neighbouring words (and the last word alone); a term's weight is its length in code points, summed
over its occurrences, as longer terms are rarer.  Its 64-bit hash votes on signed bits: a bit is one if more weight
votes for it than against.  Votes are counted in packed lanes, two bits to a sum, inside one hash aggregate.

The edited text of a document ends in the beginning of the next document by doc_id.  Documents are dealt to ranges of
doc_id, each range also gets the first document of the range after it, and within a range the next document is a
window function: the texts are shuffled once, and votes, likenesses and neighbours need no further shuffle.

Search: the 64 bits fall into ``radius + 3`` blocks; whatever lies within the radius agrees in three blocks at least,
so one table per choice of three blocks, keyed by these blocks' bits, meets every pair; the bits are then compared.

Defined results: null text counts as empty, its fingerprint is zero; null doc_ids come first in the order; rows of
equal doc_id follow one another by their text, and each row has its own output row; the only document is its own next
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import WORD_BREAKS, cut, stored

LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    """Array of (hash, weight)."""
    words = F.array_remove(F.split(text, WORD_BREAKS, -1), "")
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.struct(
        F.xxhash64(a, b).alias("h"), (F.length(a) + F.coalesce(F.length(b), F.lit(0))).cast("long").alias("w"),
    ))


def voted(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Fingerprint ``fp`` (64 bits as a long) of the text of each key; the keys are unique."""
    each = rows.select(*keys, F.explode_outer(terms(F.col(text))).alias("t")).select(*keys, "t.h", "t.w")
    lanes = [F.sum(F.shiftright("h", k).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{k}") for k in range(32)]
    votes = each.groupBy(*keys).agg(F.sum("w").alias("all"), *lanes)
    fp = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(f"v{k}", 32)
        for bit, ones in ((k, low), (k + 32, high)):
            one = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(2 * ones > F.col("all"), F.lit(one)).otherwise(F.lit(0)).cast("long"))
    return votes.select(*keys, F.coalesce(fp, F.lit(0)).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _ranges(rows: DataFrame, range_chars: int) -> list[int]:
    """Inner bounds of the doc_id ranges: one number per range, whatever the ranges hold."""
    spark = rows.sparkSession
    chars = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    ranges = max(1, chars // range_chars, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = [i / ranges for i in range(1, ranges)]
    got = rows.agg(F.percentile_approx("b", F.array(*map(F.lit, cuts)), F.lit(max(10_000, 4 * ranges))).alias("q")).first()["q"] if cuts else None
    return sorted(set(got or []))


def _range_of(bounds: list[int]) -> Column:
    """Number of bounds at or below ``b``: bounds in groups, first the groups are counted, then within the group."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    array = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    whole = F.size(F.filter(array([g[0] for g in groups]), lambda x: x <= F.col("b")))
    inner = F.element_at(F.array(*map(array, groups)), F.greatest(whole, F.lit(1)))
    part = F.size(F.filter(inner, lambda x: x <= F.col("b")))
    return F.greatest(whole - 1, F.lit(0)) * step + part


def edited(docs: DataFrame, range_chars: int = 64_000_000) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp."""
    doc_id = docs["doc_id"].cast("long")
    rows = docs.select(
        doc_id.isNotNull().alias("a"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("b"), F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    rows = rows.withColumn("at", _range_of(_ranges(rows, range_chars)))
    # the first document of each range, known by its place in the order, also goes to the range before (or the last)
    order = ["a", "b", "h"]
    rows = rows.withColumn("h", F.xxhash64("text"))
    first = rows.groupBy("at").agg(F.min(F.struct(*order)).alias("k")).orderBy("at").collect()
    home = rows.withColumn("extra", F.lit(False))
    if not first:
        guests = home.limit(0)
    else:
        before = [(first[i - 1]["at"], r["at"], r["k"]["a"], r["k"]["b"], r["k"]["h"]) for i, r in enumerate(first)]
        table = rows.sparkSession.createDataFrame(before, "goes int, at int, a boolean, b long, h long")
        guests = rows.join(F.broadcast(table), ["at", *order]).select(
            "a", "b", "text", F.col("goes").alias("at"), "h", F.lit(True).alias("extra")
        )
    both = home.unionByName(guests)
    line = Window.partitionBy("at").orderBy("extra", *order)
    both = both.withColumn("seq", F.row_number().over(line)).withColumn("next", F.lead("text").over(line))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    text = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half))
    both = both.withColumn("edited", F.when(~F.col("extra"), text)).withColumn("n_chars", n.cast("long"))
    both = both.withColumn("sha", F.sha2("edited", 256))
    keys = ["at", "seq", "extra", "a", "b", "n_chars", "sha"]
    texts = both.select(*keys, F.posexplode(F.when(F.col("extra"), F.array("text")).otherwise(F.array("text", "edited"))).alias("which", "body"))
    prints = voted(texts, [*keys, "which"], "body")
    line = Window.partitionBy("at").orderBy("seq", "which")
    # by seq and kind: a document's text, its edited text, then the next document's text
    prints = prints.withColumn("edited_fp", F.lead("fp", 1).over(line)).withColumn("next_fp", F.lead("fp", 2).over(line))
    return prints.where(~F.col("extra") & (F.col("which") == 0)).select(
        F.when(F.col("a"), F.col("b")).alias("doc_id"), "n_chars", F.col("sha").alias("edited_sha256"), "fp", "edited_fp", "next_fp"
    )


def block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp)`` -> ``(fp, tab, key)`` for each choice of three of the ``radius + 3`` blocks."""
    blocks = radius + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), 3):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("tab", "key"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """Distinct ``queries(fp)`` against distinct ``prints(fp)``: pairs (query, fp, bits) within the radius."""
    asked = block_tables(queries, radius).withColumnRenamed("fp", "query")
    bits = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    near = block_tables(prints, radius).join(asked, ["tab", "key"]).where(bits <= radius)
    return near.select("query", "fp", bits.alias("bits")).distinct()


def fingerprints(docs: DataFrame, radius: int = 3, every: int = 20) -> DataFrame:
    """One row per document with fingerprints and likenesses; ``n_near`` counts the other documents within the radius
    for the query rows, those whose doc_id is divisible by ``every`` (null elsewhere)."""
    rows = stored(edited(docs))
    copies = cut(rows.groupBy("fp").agg(F.count("*").alias("n"), F.max(F.col("doc_id") % every == 0).alias("asked")))
    near = within_radius(copies.select("fp"), copies.where("asked").select("fp"), radius)
    near = cut(near.join(copies, "fp").groupBy("query").agg((F.sum("n") - 1).alias("n_near")))
    text = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    asked = F.col("doc_id") % every == 0
    return rows.join(near, rows["fp"] == near["query"], "left").select(
        "doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"),
    )
