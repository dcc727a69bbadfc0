"""Running totals, exact quantiles and percent ranks over range partitions equal pandas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bazaar.functions.ranks import exact_quantiles, pct_rank_tables, running_totals


@pytest.fixture(scope="module")
def rows(spark):
    """Three groups of very unequal size and a null one; a value held by a third of all rows."""
    n = F.col("id")
    group = F.when(n % 50 == 0, "small").when(n % 50 == 1, F.lit(None)).when(n % 50 == 2, "narrow").otherwise("large")
    value = F.when(n % 3 == 0, 7.0).when(n % 50 == 2, n % 4).otherwise((n * 37) % 1009 - 300)
    return spark.range(6000).select(group.alias("g"), value.cast("double").alias("v"))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_running_totals(spark, rows, coalesce):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = running_totals(rows.groupBy("g", "v").agg(F.count("*").alias("n")), ["g"], "v", ["n"]).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    want = rows.groupBy("g", "v").agg(F.count("*").alias("n")).toPandas().fillna({"g": "?"}).sort_values(["g", "v"])
    want["n_before"] = want.groupby("g")["n"].cumsum() - want["n"]
    want["n_total"] = want.groupby("g")["n"].transform("sum")
    got = got.fillna({"g": "?"}).sort_values(["g", "v"])
    assert got[want.columns].values.tolist() == want.values.tolist()


def test_quantiles_and_ranks(spark, rows):
    pdf = rows.toPandas().fillna({"g": "?"})
    for r in exact_quantiles(rows, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect():
        v = pdf[pdf["g"] == (r["g"] or "?")]["v"]
        assert r["n"] == len(v) and r["q"] == pytest.approx(v.quantile([0.0, 0.25, 0.5, 0.9, 1.0]).tolist())
    got = pct_rank_tables(rows.withColumn("w", -F.col("v")), {"up": ("v", True), "down": ("v", False), "minus": ("w", True)})
    for name, group in got.toPandas().groupby("name"):
        x = pdf["v"] if name != "minus" else -pdf["v"]
        rank = pd.Series(x.rank(pct=True, ascending=name != "down").values, index=x.values).groupby(level=0).first()
        assert group.set_index("v")["pct"].sort_index().to_dict() == pytest.approx(rank.sort_index().to_dict())


def test_nothing_to_rank(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, ["g"], "v", [0.5]).collect() == []
    assert pct_rank_tables(empty, {"p": ("v", True)}).collect() == []


def test_input_is_read_once(spark, rows):
    """The plan behind the running totals starts at the stored rows."""
    plan = running_totals(rows.groupBy("v").agg(F.count("*").alias("n")), [], "v", ["n"])._jdf.queryExecution().toString()
    assert "Range (" not in plan
