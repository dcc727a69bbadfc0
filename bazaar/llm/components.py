"""Connected components of a link table by alternating large-star and small-star contraction.

Each step is a grouped minimum and a join, so no component, hub or link list is ever gathered in one task or on the
driver.  Minima are cut off (checkpointed) before the join so that both join sides are plain exchanges and adaptive
execution can split a hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import cut

LOCAL = 500_000  # links that one task contracts in memory


def _least(edges: DataFrame) -> DataFrame:
    return cut(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _local(edges: DataFrame, parts: int) -> DataFrame:
    """Links contracted within partitions of a bounded size: each node to the least of its local component."""

    def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
        stars = [(x, root(x)) for x in list(parent)]
        yield pd.DataFrame([(x, y) for x, y in stars if x != y], columns=["a", "b"], dtype="int64")

    return edges.coalesce(parts).mapInPandas(contract, edges.schema)


def components(links: DataFrame, local_links: int = LOCAL) -> DataFrame:
    """``links(a, b)`` of longs -> ``(node, root)`` for every node with a link; the root is its component's least node.

    Self links and repeated links are ignored; no link gives an empty table.  Links are first contracted within
    partitions of at most about ``local_links``; if there is more than one such partition, star steps follow until
    nothing changes.
    """
    oriented = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut(oriented)
    parts = -(-edges.count() // local_links)
    edges = cut(_local(edges, parts)) if parts else edges
    seen, now = None, _mark(edges) if parts > 1 else None
    while seen != now:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = cut(
            both.join(_least(both), "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        low = _least(large)
        pairs = large.join(low, "a")
        edges = cut(
            pairs.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        seen, now = now, _mark(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
