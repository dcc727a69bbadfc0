"""Drift over many columns, over event-time windows, and of attributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import running_totals
from ..session import cut
from .experiments import ks_drift

Z_95 = 1.6448536269514722  # one-sided 95 % point of the normal distribution
EDGES = [50.0 * i for i in range(1, 11)]


def _long(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(F.explode(each).alias("f")).select("f.feature", "f.value").where(F.col("value").isNotNull())


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of each numeric column that both tables have."""
    common = [c for c in columns if c in reference.columns and c in current.columns]
    return ks_drift(_long(reference, common, "double"), _long(current, common, "double"), "feature", "value")


def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Chi-square test of equal shares of each categorical column that both tables have.

    Drift by the cube-root normal approximation of the chi-square distribution at 5 %.
    """
    common = [c for c in columns if c in reference.columns and c in current.columns]
    a = _long(reference, common, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("a")).withColumn("b", F.lit(0))
    b = _long(current, common, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("b")).withColumn("a", F.lit(0))
    cells = a.unionByName(b).groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    sums = cells.groupBy("feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count(F.lit(1)).alias("k"))
    j = cells.join(sums, "feature")
    both = F.col("a") + F.col("b")
    ea, eb = both * F.col("na") / (F.col("na") + F.col("nb")), both * F.col("nb") / (F.col("na") + F.col("nb"))
    part = F.try_divide((F.col("a") - ea) * (F.col("a") - ea), ea) + F.try_divide((F.col("b") - eb) * (F.col("b") - eb), eb)
    g = j.groupBy("feature").agg(F.sum(part).alias("chi2"), F.max("na").alias("n_ref"), F.max("nb").alias("n_cur"), (F.max("k") - 1).alias("dof"))
    w = F.try_divide(F.lit(2.0), 9.0 * F.col("dof"))
    z = F.try_divide(F.pow(F.try_divide("chi2", "dof"), F.lit(1 / 3)) - (1 - w), F.sqrt(w))
    return g.select("feature", F.round("chi2", 6).alias("chi2"), "dof", "n_ref", "n_cur",
                    (F.when(F.col("dof") > 0, F.round(z, 6)) > Z_95).alias("drifted"))


def wasserstein_drift(reference: DataFrame, current: DataFrame, columns: list[str], threshold: float = 0.1) -> DataFrame:
    """Wasserstein-1 distance of each numeric column that both tables have, in standard deviations of the reference.

    The distance is the area between the two distribution functions: over the distinct values in order, their gap times
    the way to the next value, which an equi-join on the running number of the value finds.  A column without a value on
    one side has no distance and has not drifted.
    """
    common = [c for c in columns if c in reference.columns and c in current.columns]
    ref = _long(reference, common, "double")
    a = ref.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("a")).withColumn("b", F.lit(0))
    b = _long(current, common, "double").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("b")).withColumn("a", F.lit(0))
    u = a.unionByName(b).groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("one", F.lit(1))
    u = cut(running_totals(u, ["feature"], "value", ["a", "b", "one"]))
    gap = F.abs(F.try_divide(F.col("a_before") + F.col("a"), F.col("a_total")) - F.try_divide(F.col("b_before") + F.col("b"), F.col("b_total")))
    here = u.select("feature", "value", F.col("one_before").alias("k"), gap.alias("gap"), F.col("a_total").alias("n_ref"), F.col("b_total").alias("n_cur"))
    after = u.select("feature", F.col("value").alias("next"), (F.col("one_before") - 1).alias("k"))
    area = here.join(after, ["feature", "k"], "left").groupBy("feature").agg(
        F.sum(F.when(F.col("next").isNull(), F.col("gap") * 0.0).otherwise(F.col("gap") * (F.col("next") - F.col("value")))).alias("area"),
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))
    spread = ref.groupBy("feature").agg(F.greatest(F.stddev_pop("value"), F.lit(0.001)).alias("spread"))
    out = area.join(spread, "feature", "left").select("feature", (F.col("area") / F.col("spread")).alias("distance"), "n_ref", "n_cur")
    return out.withColumn("drifted", F.coalesce(F.col("distance") >= threshold, F.lit(False)))


def jensen_shannon_drift(reference: DataFrame, current: DataFrame, columns: list[str], threshold: float = 0.1) -> DataFrame:
    """Jensen-Shannon distance (root of the divergence, natural logarithms) of each categorical column that both
    tables have; a column without a value on one side has no distance and has not drifted."""
    common = [c for c in columns if c in reference.columns and c in current.columns]
    a = _long(reference, common, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("a")).withColumn("b", F.lit(0))
    b = _long(current, common, "string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("b")).withColumn("a", F.lit(0))
    cells = a.unionByName(b).groupBy("feature", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    sums = cells.groupBy("feature").agg(F.sum("a").alias("n_ref"), F.sum("b").alias("n_cur"))
    j = cells.join(sums, "feature").withColumn("p", F.try_divide("a", "n_ref")).withColumn("q", F.try_divide("b", "n_cur"))
    mean = (F.col("p") + F.col("q")) / 2
    half = lambda c: F.when(F.col(c) > 0, F.col(c) * F.ln(F.col(c) / mean)).when(F.col(c) == 0, F.lit(0.0))
    g = j.groupBy("feature").agg(F.sum(half("p") + half("q")).alias("_d"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))
    out = g.select("feature", F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.sqrt(F.greatest(F.col("_d"), F.lit(0.0)) / 2)).alias("distance"), "n_ref", "n_cur")
    return out.withColumn("drifted", F.coalesce(F.col("distance") >= threshold, F.lit(False)))


#: Tests by name, each giving a row a column with ``drifted``.
NUMERIC_TESTS = {"ks": numeric_drift, "wasserstein": wasserstein_drift}
CATEGORICAL_TESTS = {"chi2": categorical_drift, "jensen_shannon": jensen_shannon_drift}


def column_drift(reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], test: str = "ks",
                 categorical_test: str = "chi2") -> DataFrame:
    """One row per column: its test's statistic and verdict, by the tests of the given names."""
    stat = {"ks": F.round("ks_stat", 9), "chi2": F.col("chi2")}
    both = ((NUMERIC_TESTS[test], test, numeric), (CATEGORICAL_TESTS[categorical_test], categorical_test, categorical))
    n, c = (f(reference, current, columns).select(
        "feature", F.lit(name).alias("test"), stat.get(name, F.round("distance", 9)).alias("stat"), "n_ref", "n_cur",
        F.coalesce("drifted", F.lit(False)).alias("drifted")) for f, name, columns in both)
    return n.unionByName(c)


def _shares(n: str) -> list:
    return [F.sum((F.col("value") <= e).cast("bigint")).alias(f"{n}_{i}") for i, e in enumerate(EDGES)]


def window_counts(events: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Cumulative value counts per event-time window and type; the same on a stream (watermarked) and a batch.

    The state of a window is a fixed number of counts, so nothing is buffered or dropped but late rows.
    """
    if events.isStreaming:
        events = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    g = events.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), *_shares("le"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", *[f"le_{i}" for i in range(len(EDGES))])


def window_drift(counts: DataFrame, reference: DataFrame, least: int = 10, threshold: float = 0.2) -> DataFrame:
    """Greatest difference of a window's distribution from the reference rows', for windows of ``least`` rows."""
    ref = reference.groupBy("event_type").agg(F.count(F.lit(1)).alias("m"), *_shares("ref"))
    j = counts.where(F.col("n") >= least).join(ref, "event_type")  # a row per type
    gaps = [F.abs(F.col(f"le_{i}") / F.col("n") - F.col(f"ref_{i}") / F.col("m")) for i in range(len(EDGES))]
    return j.select("window_start", "event_type", "n", F.greatest(*gaps).alias("distance")).withColumn("drifted", F.col("distance") > threshold)


def attribution_drift(contribs: DataFrame, baseline: DataFrame, by: list[str], top: int = 10, alert: float = 0.5) -> DataFrame:
    """``contribs(by..., feature, value)`` against ``baseline(feature, mean_abs)``: for the baseline's top features
    the ratio of change of the mean absolute value, and whether it is over ``alert``.

    Groups whose features differ from the baseline's are left out.
    """
    now = contribs.groupBy(*by, "feature").agg(F.avg(F.abs("value")).alias("current"))
    names = baseline.agg(F.array_sort(F.collect_set("feature"))).scalar()
    same = now.groupBy(*by).agg(F.array_sort(F.collect_set("feature")).alias("_f")).where(F.col("_f") == names).drop("_f")
    best = baseline.orderBy(F.desc("mean_abs"), "feature").limit(top)
    j = now.join(same, by, "left_semi").join(best, "feature")
    ratio = F.abs(F.col("current") - F.col("mean_abs")) / F.greatest(F.col("mean_abs"), F.lit(1e-6))
    return j.select(*by, "feature", F.round("current", 9).alias("current"), F.round("mean_abs", 9).alias("baseline"),
                    F.round(ratio, 9).alias("drift_ratio"), (F.round(ratio, 9) > alert).alias("alert"))
