"""Resharding by minimum-cost flow: from the old shard sizes and the new capacities, the block transfers that move
the fewest bytes, then a rewrite of the affected files only.

Sizes are UTF-8 bytes of the text plus 8.  Old placement: given, or by a hash of doc_id.  Each old shard is cut into
blocks (by size class, large ones first, and hash); block sizes give prefix sums of bytes over a shard in two levels, so no shard is ever sorted in one
task.  The flow runs between shards (a graph of a fixed size: old shards x new shards); a shard keeps the front of its
byte range and its transfers are the slices after it, so a document moves just if its range lies in a sent slice.

Result: shard sizes differ from the capacity by less than a few documents (law ``bytes``), and no plan moves fewer
bytes up to that rounding.

Defined results: null text has size 8 and crc32 0; a null doc_id is hashed by its text; ties and repeated rows are
interchangeable, each row gets its own slot; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaar.llm.common import ROW, cut, packed

EXTRA = 8


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]] | None = None) -> dict[tuple[int, int], int]:
    """Bytes sent from each old to each new shard, at least cost (default: 1 a byte unless it stays).

    Successive cheapest paths on the bipartite graph, whose size is the number of shards.
    """
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards can't hold everything")
    price = cost or [[int(i != j) for j in range(m)] for i in range(n)]
    flow: dict[tuple[int, int], int] = defaultdict(int)
    left, room = list(supply), list(capacity)
    while any(left):
        far: dict[tuple[str, int], float] = {("s", i): 0 for i in range(n) if left[i]}
        came: dict[tuple[str, int], tuple[str, int]] = {}
        changed = True
        while changed:
            changed = False
            for i in range(n):
                if ("s", i) not in far:
                    continue
                for j in range(m):
                    d = far["s", i] + price[i][j]
                    if d < far.get(("t", j), float("inf")):
                        far["t", j], came["t", j], changed = d, ("s", i), True
            for (i, j), sent in flow.items():
                if sent and ("t", j) in far and far["t", j] - price[i][j] < far.get(("s", i), float("inf")):
                    far["s", i], came["s", i], changed = far["t", j] - price[i][j], ("t", j), True
        end = min((("t", j) for j in range(m) if room[j]), key=lambda t: (far[t], t))
        path, node = [end], end
        while node in came:
            node = came[node]
            path.append(node)
        path.reverse()
        steps = list(zip(path, path[1:], strict=False))
        back = [flow[b[1], a[1]] for a, b in steps if a[0] == "t"]
        amount = min([left[path[0][1]], room[end[1]], *back])
        for a, b in steps:
            if a[0] == "s":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        left[path[0][1]] -= amount
        room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def _spread(doc_id: Column, text: Column, salt: str) -> Column:
    return F.xxhash64(F.lit(salt), F.coalesce(doc_id.cast("string"), text, F.lit("")))


def by_hash(doc_id: Column, text: Column, shards: int) -> Column:
    """The default old placement."""
    return F.pmod(_spread(doc_id, text, "old"), F.lit(shards)).cast("int")


def plan(rows: DataFrame, old_shards: int, new_shards: int, blocks: int) -> DataFrame:
    """``rows(old, key, size, ...)`` -> the same rows with ``shard`` and ``slot``."""
    # large documents first: what is sent lies at the end, so the slices end between small documents
    spread = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks))
    rows = cut(rows.withColumn("block", ((64 - F.floor(F.log2("size"))) * blocks + spread).cast("int")))
    # at most old_shards * 64 * blocks rows, a fixed number
    per_block = cut(rows.groupBy("old", "block").agg(F.sum("size").alias("bytes")))
    sizes = {r["old"]: r["bytes"] for r in per_block.groupBy("old").agg(F.sum("bytes").alias("bytes")).collect()}
    supply = [int(sizes.get(i, 0)) for i in range(old_shards)]
    flow = min_cost_flow(supply, equal_capacities(sum(supply), new_shards))
    # the slice [low, high) of each old shard's bytes that goes to a new shard; what stays comes first
    slices = []
    for i in range(old_shards):
        low = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j)):
            slices.append((i, j, low, low + flow[i, j]))
            low += flow[i, j]
    table = F.broadcast(rows.sparkSession.createDataFrame(slices or [(0, 0, 0, 1)], "old int, shard int, low long, high long"))
    fore = Window.partitionBy("old").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("old", "block", F.coalesce(F.sum("bytes").over(fore), F.lit(0)).alias("before"))
    within = Window.partitionBy("old", "block").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(F.broadcast(offsets), ["old", "block"]).withColumn(
        "at", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.floor(F.col("size") / 2)
    )
    placed = cut(
        placed.join(table, (placed["old"] == table["old"]) & (placed["at"] >= table["low"]) & (placed["at"] < table["high"]))
        .drop(table["old"]).drop("before", "at", "low", "high")
    )
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    fore = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = cut(counts.select("shard", "block", F.coalesce(F.sum("n").over(fore), F.lit(0)).alias("first")))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("key", "size", "old"))
    return placed.join(F.broadcast(first), ["shard", "block"]).withColumn("slot", F.col("first") + rank - 1).drop("first", "block")


def reshard(docs: DataFrame, old_shards: int = 24, new_shards: int = 24, old: Column | None = None, blocks: int = 64) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard."""
    doc_id, text = docs["doc_id"], docs["text"]
    rows = docs.select(
        doc_id, (F.coalesce(F.octet_length(text), F.lit(0)) + EXTRA).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        _spread(doc_id, text, "key").alias("key"),
        (by_hash(doc_id, text, old_shards) if old is None else old.cast("int")).alias("old"),
    )
    return plan(rows, old_shards, new_shards, blocks).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """A first layout: one folder a shard, by the hash of doc_id."""
    where = by_hash(docs["doc_id"], docs["text"], shards)
    docs.withColumn("shard", where).repartition("shard").write.partitionBy("shard").parquet(path)


def rewrite(spark: SparkSession, source: str, target: str, old_shards: int, new_shards: int, blocks: int = 64) -> list[int]:
    """Rewrite the shards of ``source`` that the plan changes, into ``target``; gives the affected shards.

    A shard that neither sends nor receives is not rewritten and stays where it is.
    """
    docs = spark.read.parquet(source)
    body = docs.drop("shard")
    rows = packed(docs, "doc_id", "text", "shard").select(
        ROW, F.col("shard").cast("int").alias("old"), _spread(F.col("doc_id"), F.col("text"), "key").alias("key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + EXTRA).cast("long").alias("size"),
    )
    placed = plan(rows, old_shards, new_shards, blocks)
    moved = placed.where(F.col("shard") != F.col("old")).select("old", "shard").distinct().collect()
    affected = sorted({x for r in moved for x in (r["old"], r["shard"])})
    out = placed.where(F.col("shard").isin(affected or [-1])).select(
        *[F.col(f"{ROW}.`{c}`").alias(c) for c in body.columns], "shard"
    )
    out.repartition("shard").write.partitionBy("shard").parquet(target)
    return affected
