"""Grouped statistics built from Spark aggregates (box plots, histograms, quantile bins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import exact_quantiles


def quantiles(c: str | Column, probs, exact: bool = True, accuracy: int = 10000) -> Column:
    """Array of quantiles of ``c``.

    ``exact=True`` is linear interpolation between order statistics (same as SQL
    ``percentile_cont``); it keeps a value->count map per group, fine when the
    group has few distinct values.  ``exact=False`` uses the mergeable
    ``percentile_approx`` sketch, with bounded memory for groups of any size.
    """
    col = F.col(c) if isinstance(c, str) else c
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if exact:
        return F.percentile(col.cast("double"), arr)
    return F.percentile_approx(col.cast("double"), arr, accuracy)


def box_stats(df: DataFrame, group: str | list[str], value: str) -> DataFrame:
    """q1, median, q3, and whiskers (furthest points within 1.5 IQR) per group.

    Quartiles come from running counts of distinct values, the whiskers from the same distinct values after joining
    the quartiles (one row per group) back on the group key.
    """
    keys = [group] if isinstance(group, str) else list(group)
    values = df.select(*keys, F.col(value).cast("double").alias("_v"))
    q = exact_quantiles(values, keys, "_v", [0.25, 0.5, 0.75])
    q = q.select(*keys, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    j = values.distinct().join(q, keys)
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    w = j.groupBy(*keys).agg(F.min(F.when(F.col("_v") >= lo, F.col("_v"))).alias("whisker_low"),
                             F.max(F.when(F.col("_v") <= hi, F.col("_v"))).alias("whisker_high"))
    return q.join(w, keys)


def equal_width_bin(c: Column, lo: Column, hi: Column, bins: int) -> Column:
    """numpy-histogram bin index in [0, bins-1]; the right edge belongs to the last bin."""
    width = (hi - lo) / bins
    idx = F.floor((c - lo) / width)
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(idx, F.lit(bins - 1))).cast("int")


def cut(c: Column, edges, labels, right: bool = True) -> Column:
    """pandas.cut with explicit edges: right-closed (a, b] or left-closed [a, b); outside -> null."""
    out = F.lit(None).cast("string")
    for a, b, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        cond = (c > a) & (c <= b) if right else (c >= a) & (c < b)
        out = F.when(cond, F.lit(lab)).otherwise(out)
    return out
