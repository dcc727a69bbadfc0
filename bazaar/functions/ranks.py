"""Exact ranks, running totals and quantiles without a window over a whole table or group.

A plain ``Window.orderBy(x)`` moves every row into one task.  Here:

1. rows are reduced to a value-frequency table (one row per distinct value of a group, so a value held by a third of
   all rows is one row);
2. that table is range-partitioned by group and value, so a partition holds a stretch of the sorted table and a large
   group spreads over many; the number of partitions is the session's ``spark.sql.shuffle.partitions``, which adaptive
   execution lowers to what the data fill;
3. a window inside a group's part of a partition gives the local running total; it streams over sorted rows that may
   spill.  The result is stored once in the shared folder, the input is read once;
4. the sums of each group and partition (at most as many rows as groups and partitions together) give the offsets;
   offset + local = total over all smaller values.

Storing also fixes the partition numbers: the offsets and the rows they belong to come from one and the same cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut


def running_totals(table: DataFrame, group: list[str], value: str, sums: list[str]) -> DataFrame:
    """Adds ``<c>_before`` (sum of c over smaller values of the group) and ``<c>_total`` for each c in ``sums``.

    ``table`` has one row per group and value; a null value sorts first.
    """
    ranged = table.repartitionByRange(*group, value).withColumn("_b", F.spark_partition_id())
    near = Window.partitionBy(*group, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = cut(ranged.select("*", *[F.coalesce(F.sum(c).over(near), F.lit(0)).alias(f"_l_{c}") for c in sums]))
    totals = local.groupBy(*group, "_b").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    whole = Window.partitionBy(*group)
    fore = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_b").alias("_ob"),
        *[F.coalesce(F.sum(f"_s_{c}").over(fore), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_s_{c}").over(whole).alias(f"{c}_total") for c in sums],
    )
    same = F.col("_b") == F.col("_ob")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return local.join(offsets, same).select(
        *table.columns, *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"{c}_before") for c in sums], *[f"{c}_total" for c in sums]
    )


def value_rank_table(df: DataFrame, value: Column | str) -> DataFrame:
    """Per distinct value v: ``n_less`` (#rows < v), ``n_eq`` (#rows == v), ``n_total``.

    Null values are dropped (pandas ranks ignore NaN).
    """
    v = F.col(value) if isinstance(value, str) else value
    counts = df.select(v.cast("double").alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(
        F.count(F.lit(1)).alias("n_eq"))
    ranked = running_totals(counts, [], "v", ["n_eq"])
    return ranked.select("v", "n_eq", F.col("n_eq_before").alias("n_less"), F.col("n_eq_total").alias("n_total"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Interpolated quantiles (as SQL ``percentile_cont``) per group: keys, ``n`` and the array ``q``.

    The two order statistics around each position are read off the running counts of distinct values.
    """
    v = F.col(value).cast("double")
    counts = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, keys, "_v", ["_n"])

    def at(i: Column) -> Column:
        return F.max(F.when((F.col("_n_before") <= i) & (i < F.col("_n_before") + F.col("_n")), F.col("_v")))

    picks = []
    for k, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("_n_total") - 1)
        picks += [at(F.floor(position)).alias(f"_lo{k}"), at(F.ceil(position)).alias(f"_hi{k}")]
    got = ranked.groupBy(*keys).agg(F.max("_n_total").alias("n"), *picks)

    def between(k: int) -> Column:
        position = F.lit(float(probs[k])) * (F.col("n") - 1)
        low, high = F.col(f"_lo{k}"), F.col(f"_hi{k}")
        whole = F.floor(position) == F.ceil(position)
        return F.when(whole, low).otherwise((F.ceil(position) - position) * low + (position - F.floor(position)) * high)

    return got.select(*keys, "n", F.array(*[between(k) for k in range(len(probs))]).alias("q"))


def _average_rank() -> Column:
    return (F.col("n_less") + (F.col("n_eq") + 1) / 2.0) / F.col("n_total")


def pct_rank_average(df: DataFrame, value: str, out: str, ascending: bool = True) -> DataFrame:
    """pandas ``rank(pct=True, method='average')``: (average 1-based rank of ties) / n, nulls stay null."""
    key = F.col(value).cast("double") if ascending else -F.col(value).cast("double")
    t = value_rank_table(df, key).select(F.col("v").alias("_rk_v"), _average_rank().alias(out))
    return df.withColumn("_rk_v", key).join(t, "_rk_v", "left").drop("_rk_v")


def pct_rank_tables(df: DataFrame, ranks: dict[str, tuple[str, bool]]) -> DataFrame:
    """Average-tie percent ranks of several columns (``name -> (column, ascending)``) from one read of ``df``.

    One row per name and distinct value (as double): ``name``, ``v``, ``pct``.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), F.col(c).cast("double").alias("v"), F.lit(asc).alias("asc"))
                      for name, (c, asc) in ranks.items()])
    long = df.select(F.inline(pairs)).where(F.col("v").isNotNull())
    signed = F.when(F.col("asc"), F.col("v")).otherwise(-F.col("v"))
    counts = long.groupBy("name", signed.alias("_s"), "v").agg(F.count(F.lit(1)).alias("n_eq"))
    ranked = running_totals(counts, ["name"], "_s", ["n_eq"])
    named = ranked.withColumnsRenamed({"n_eq_before": "n_less", "n_eq_total": "n_total"})
    return named.select("name", "v", _average_rank().alias("pct"))
