"""Order anomalies: features, scaling, isolation forest.

Forest: each row goes to as many trees as the sample size asks for, by hashes, so all trees' samples come from one
pass; a tree is built from at most ``SAMPLE`` rows in one group.  The forest is a table of nodes of a fixed size, so
it may travel to the scoring tasks, which score every row in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ["final_amount_inr", "discount_pct", "delivery_days", "is_return"]
TREES, SAMPLE, CONTAMINATION, SEED = 100, 256, 0.02, 42
NODES = "tree int, node int, feature int, threshold double, depth int, size int"


def anomaly_features(fact: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Amount, clipped discount share, delivery days, return flag; rows without amount, list price or days go."""
    f = fact.where(F.col("final_amount_inr").isNotNull() & (F.col("mrp_inr") > 0) & F.col("delivery_days").isNotNull())
    return with_discount(f.withColumn("is_return", (F.col("return_status") == "Returned").cast("int"))).select(key, *FEATURES)


def with_discount(df: DataFrame) -> DataFrame:
    """Features of rows to score: nulls count as 0, a list price of 0 as no discount, ``is_returned`` will do."""
    if "is_return" not in df.columns:
        df = df.withColumn("is_return", F.col("is_returned").cast("int") if "is_returned" in df.columns else F.lit(0))
    amount, mrp = F.col("final_amount_inr").cast("double"), F.col("mrp_inr").cast("double")
    share = F.coalesce(F.least(F.greatest(1 - amount / F.nullif(mrp, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    df = df.withColumn("discount_pct", share)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})


def scaling(features: DataFrame) -> DataFrame:
    """One row (feature, mean, std) per feature, population deviation."""
    row = features.agg(*[f(F.col(c)).alias(f"{k}_{c}") for c in FEATURES for k, f in (("m", F.avg), ("s", F.stddev_pop))])
    parts = ", ".join(f"'{c}', m_{c}, s_{c}" for c in FEATURES)
    return row.selectExpr(f"stack({len(FEATURES)}, {parts}) AS (feature, mean, std)")


def scaled(features: DataFrame, stats: DataFrame) -> DataFrame:
    """Features less mean over deviation (a constant feature only less its mean)."""
    by = {r["feature"]: (r["mean"], r["std"] or 1.0) for r in stats.collect()}  # one row a feature
    return features.withColumns({c: (F.col(c) - by[c][0]) / by[c][1] for c in FEATURES})


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, int, float, int, int]]:
    """Nodes (number, feature or -1, threshold, depth, rows) of one tree; node n has children 2n + 1 and 2n + 2."""
    out, todo = [], [(0, x, 0)]
    while todo:
        node, rows, depth = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(open_):
            out.append((node, -1, 0.0, depth, len(rows)))
            continue
        f = int(rng.choice(open_))
        at = float(rng.uniform(low[f], high[f]))
        left = rows[:, f] <= at
        if left.all():
            at, left = float(low[f]), rows[:, f] <= low[f]
        out.append((node, f, at, depth, len(rows)))
        todo += [(2 * node + 1, rows[left], depth + 1), (2 * node + 2, rows[~left], depth + 1)]
    return out


def grow_forest(rows: DataFrame, key: str, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """The nodes of all trees; ``rows(key, features...)`` scaled."""
    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], NODES)
    want = 1.3 * trees * sample / n  # chosen a little high, as each tree then keeps its least hashes
    copies = max(1, math.ceil(want))
    draw = F.pmod(F.xxhash64(F.lit(SEED), key, "i"), F.lit(1 << 30)) / float(1 << 30)
    each = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(copies)))).where(draw < want / copies)
    each = each.select(F.pmod(F.xxhash64(F.lit(SEED + 1), key, "i"), F.lit(trees)).cast("int").alias("tree"),
                       F.xxhash64(F.lit(SEED + 2), key, "i").alias("o"), *FEATURES)
    limit = math.ceil(math.log2(sample))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        t = int(group["tree"].iloc[0])
        x = group.sort_values("o")[FEATURES].to_numpy(float)[:sample]
        nodes = _grow(x, np.random.default_rng([SEED, t]), limit)
        return pd.DataFrame([(t, *v) for v in nodes], columns=["tree", "node", "feature", "threshold", "depth", "size"])

    return each.groupBy("tree").applyInPandas(build, NODES)


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        long = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def score_samples(rows: DataFrame, forest: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows with ``raw_score`` (nearer -1: easier to isolate)."""
    nodes = forest.toPandas()  # at most trees x 2 x sample rows
    trees = []
    for _, t in nodes.groupby("tree"):
        size = int(t["node"].max()) + 1
        feature, at, end = np.full(size, -1), np.zeros(size), np.zeros(size)
        feature[t["node"]], at[t["node"]] = t["feature"], t["threshold"]
        end[t["node"]] = t["depth"] + _mean_path(t["size"])
        trees.append((feature, at, end, int(t["size"].max())))
    norm = float(_mean_path(np.array([max((t[3] for t in trees), default=2)]))[0]) or 1.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[FEATURES].to_numpy(float)
            total = np.zeros(len(x))
            for feature, at, end, _ in trees:
                node = np.zeros(len(x), np.int64)
                live = np.flatnonzero(feature[node] >= 0)
                while len(live):
                    f = feature[node[live]]
                    node[live] = 2 * node[live] + 1 + (x[live, f] > at[node[live]])
                    live = live[feature[node[live]] >= 0]
                total += end[node]
            yield batch.assign(raw_score=-np.exp2(-total / max(len(trees), 1) / norm))

    return rows.mapInPandas(score, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", raw_score double")


def flag(scored: DataFrame, offset: float | None = None, contamination: float = CONTAMINATION) -> DataFrame:
    """``anomaly_score`` (raw score less the offset; higher is more normal) and ``is_anomaly`` below 0.

    Without an offset it is the ``contamination`` quantile of these rows' scores.
    """
    cut_at = F.lit(offset) if offset is not None else scored.agg(F.percentile_approx("raw_score", contamination, 100_000)).scalar()
    return scored.withColumn("anomaly_score", F.col("raw_score") - cut_at).withColumn("is_anomaly", F.col("anomaly_score") < 0).drop("raw_score")


def score_summary(flagged: DataFrame) -> DataFrame:
    """Rows, flagged rows and moments of the score."""
    s = F.col("anomaly_score")
    return flagged.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_anomaly").cast("bigint")).alias("n_anomalies"),
                       F.avg(s).alias("score_mean"), F.stddev_pop(s).alias("score_std"), F.min(s).alias("score_min"), F.max(s).alias("score_max"))
