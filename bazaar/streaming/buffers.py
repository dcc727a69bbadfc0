"""Monitors that act after so many rows, as arbitrary keyed state of a stream (X4, X5), and a replay-safe log.

A row is first turned into a vector by column expressions (what it adds to the sums of its key).  The state of a key is
a row count, the first row's vector and the sums so far: a fixed size, whatever arrives, so no row is dropped or kept.
After each row the state is looked at: with ``every`` rows or more, and a baseline to compare with, the sums are handed
on and the state starts anew.  Without a baseline it goes on growing in numbers only; a query restarted with one from
the same checkpoint hands all of it on with the next row.

``flushes`` is the same for a table: rows in the order of a unique column, ``every`` of them a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.ranks import running_totals

STATE = "n long, flush long, first array<double>, sums array<double>"


def flush_segments(n: int, rows: int, every: int) -> list[int]:
    """Ends of the flushed parts of ``rows`` new rows after ``n`` held ones."""
    first = max(every - n, 1)
    return list(range(first, rows + 1, every))


def stream_flushes(rows: DataFrame, key: str, vector: Column, every: int = 100, ready: bool = True) -> DataFrame:
    """key, flush (from 0), n, first, sums: one row each time a key of a streaming DataFrame has ``every`` rows.

    Rows count in the order in which they come.  ``ready`` says whether there is a baseline.
    """
    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, flush, first, sums = state.get if state.exists else (0, 0, None, None)
        first, sums = (None if x is None else np.array(x) for x in (first, sums))
        for part in parts:
            new = np.array(part["v"].tolist(), float).reshape(len(part), -1)
            start = 0
            for end in (flush_segments(n, len(new), every) if ready else []) + [len(new)]:
                if end > start:
                    first = new[start] if n == 0 else first
                    add = new[start:end].sum(axis=0)
                    sums, n, start = (add if sums is None else sums + add), n + end - start, end
                if ready and n >= every:
                    yield pd.DataFrame({"key": [k[0]], "flush": [flush], "n": [n], "first": [first], "sums": [sums]})
                    n, flush, first, sums = 0, flush + 1, None, None
        state.update((n, flush, None if first is None else first.tolist(), None if sums is None else sums.tolist()))

    named = rows.select(F.col(key).cast("string").alias("key"), vector.alias("v")).groupBy("key")
    out = named.applyInPandasWithState(step, "key string, flush long, n long, first array<double>, sums array<double>", STATE, "append", GroupStateTimeout.NoTimeout)
    return out.withColumnRenamed("key", key)


def flushes(rows: DataFrame, key: str, order: str, vector: Column, size: int, every: int = 100) -> DataFrame:
    """The same groups of a table, by ranks in the unique column ``order``; ``size`` is the vector's length."""
    one = rows.select(F.col(key).cast("string").alias(key), F.col(order).alias("_o"), vector.alias("_v"))
    at = running_totals(one.select(key, "_o", F.lit(1).alias("n")), [key], "_o", ["n"])
    at = at.select(F.col(key).alias("_k"), F.col("_o").alias("_p"), F.floor(F.col("n_before") / every).alias("flush"))
    j = one.join(at, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_o") == F.col("_p")))
    sums = [F.sum(F.get("_v", F.lit(i))).alias(f"_s{i}") for i in range(size)]
    g = j.groupBy(key, "flush").agg(F.count(F.lit(1)).alias("n"), F.min_by("_v", "_o").alias("first"), *sums)
    return g.where(F.col("n") == every).select(key, "flush", "n", "first", F.array(*[f"_s{i}" for i in range(size)]).alias("sums"))


# ------------------------------------------------------------------ X4

def drift_vector(features: list[str], edges: list[float]) -> Column:
    """For each feature: 1 if there is a value, and for each edge 1 if the value is at most the edge."""
    def of(f: str) -> list[Column]:
        v = F.col(f).cast("double")
        return [F.coalesce(c.cast("double"), F.lit(0.0)) for c in [v.isNotNull(), *[v <= e for e in edges]]]

    return F.array(*[c for f in features for c in of(f)])


def buffer_drift(flushed: DataFrame, key: str, reference: DataFrame, features: list[str], edges: list[float], threshold: float = 0.2) -> DataFrame:
    """Each flush and feature: the greatest difference of the two distributions at the edges.

    ``reference`` has the features; a feature without a value on one side has no distance and has not drifted.
    """
    width = len(edges) + 1
    size = width * len(features)
    v = reference.select(drift_vector(features, edges).alias("v"))
    base = v.agg(F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(size)]).alias("base"))
    j = flushed.withColumn("base", base.scalar())  # one row of a fixed size

    def share(column: str, i: int, e: int) -> Column:
        return F.try_divide(F.get(column, F.lit(i * width + 1 + e)), F.get(column, F.lit(i * width)))

    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.greatest(*[F.abs(share("sums", i, e) - share("base", i, e)) for e in range(len(edges))]).alias("distance"))
                     for i, f in enumerate(features)])
    out = j.select(key, "flush", "n", F.explode(each).alias("f")).select(key, "flush", "n", "f.feature", "f.distance")
    return out.withColumn("drifted", F.coalesce(F.col("distance") > threshold, F.lit(False)))


# ------------------------------------------------------------------ X5

def attribution_vector(contributions: str, names: list[str]) -> Column:
    """1 if the map column has just the named features, then the absolute value of each (0 where it is missing)."""
    same = F.array_sort(F.map_keys(contributions)) == F.array(*[F.lit(n) for n in sorted(names)])
    values = [F.coalesce(F.abs(F.try_element_at(F.col(contributions), F.lit(n)).cast("double")), F.lit(0.0)) for n in names]
    return F.array(F.coalesce(same.cast("double"), F.lit(0.0)), *values)


def buffer_attribution_drift(flushed: DataFrame, key: str, baseline: dict[str, float], top: int = 10, alert: float = 0.5) -> DataFrame:
    """Of each flush whose first row has the baseline's features, the baseline's ``top`` features: mean absolute
    contribution, ratio of its change, and whether this is over ``alert``.  ``baseline``: feature -> mean, in the
    vector's order."""
    names = list(baseline)
    best = sorted(names, key=lambda f: (-baseline[f], f))[:top]

    def row(f: str) -> Column:
        now = F.get("sums", F.lit(1 + names.index(f))) / F.col("n")
        ratio = F.abs(now - baseline[f]) / max(baseline[f], 1e-6)
        return F.struct(F.lit(f).alias("feature"), now.alias("current"), F.lit(float(baseline[f])).alias("baseline"), ratio.alias("drift_ratio"))

    same = flushed.where(F.get("first", F.lit(0)) == 1.0)
    out = same.select(key, "flush", "n", F.explode(F.array(*map(row, best))).alias("f")).select(key, "flush", "n", "f.*")
    return out.withColumn("alert", F.col("drift_ratio") > alert)


# ------------------------------------------------------------------ X10

def commit_batch(rows: DataFrame, batch_id: int, base: str) -> None:
    """One micro-batch of a log; a replayed batch replaces what its first try left."""
    rows.write.mode("overwrite").parquet(f"{base}/data/batch={batch_id}")


def run_exactly_once(log: DataFrame, base: str) -> DataFrame:
    """All there is of a streaming log, each batch committed under its number; gives the log so far.

    A batch that ran before a crash and runs again has the same number, so it adds nothing.
    """
    q = (log.writeStream.foreachBatch(lambda rows, i: commit_batch(rows, i, base))
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return log.sparkSession.read.schema(log.schema).option("basePath", f"{base}/data").parquet(f"{base}/data").select(*log.columns)
