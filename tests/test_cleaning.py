"""Cleaning counters, validation of malformed values and recommendations for every subject."""

import pytest
from pyspark.sql import functions as F

from bazaar.operators import baskets as B
from bazaar.operators import cleaning as C
from bazaar.operators import eda
from bazaar.operators import experiments as X


def test_only_changed_dates_count(spark):
    raw = spark.createDataFrame([("1", "2015-01-25"), ("2", "25/01/2015"), ("3", "nothing")], "transaction_id string, order_date string")
    log = C.cleaning_log(raw).first()
    assert (log["dates_fixed"], log["dates_sentineled"]) == (1, 1)


def test_prices_are_imputed_only_with_a_subcategory(spark):
    raw = spark.createDataFrame([("1", "₹100"), ("2", "Price on Request"), ("3", None)], "transaction_id string, original_price_inr string")
    assert C.cleaning_log(raw).first()["prices_imputed"] == 1
    assert C.cleaning_log(raw.withColumn("subcategory", F.lit("a"))).first()["prices_imputed"] == 3


def test_numbers_that_are_none_are_a_rule(spark):
    rows = spark.createDataFrame([("1", "c", "abc"), ("2", None, "5"), ("2", "d", "0.5")], "transaction_id string, customer_id string, final_amount_inr string")
    got = {r["rule"]: r["failures"] for r in C.validate_sales(rows, None, None).collect()}
    assert got == {"final_amount_inr_numeric": 1, "amount_range": 1, "transaction_id_not_null": 0, "customer_id_not_null": 1, "transaction_id_unique": 1}
    cases = {(r["rule"], r["value"], r["n"]) for r in C.failure_cases(rows).collect()}
    assert cases == {("final_amount_inr_numeric", "abc", 1), ("amount_range", "0.5", 1), ("customer_id_not_null", None, 1)}
    with pytest.raises(RuntimeError):
        C.raise_on_failures(C.validate_sales(rows, None, None))


def test_row_bounds_are_optional(spark):
    rows = spark.createDataFrame([("1",)], "transaction_id string")
    assert {r["rule"]: r["failures"] for r in C.validate_sales(rows, 2, 9).collect()}["row_count"] == 1
    assert "row_count" not in [r["rule"] for r in C.validate_products(rows.withColumnRenamed("transaction_id", "product_id"), None, None).collect()]


def test_every_subcategory_gets_recommendations(spark):
    """Sixty subcategories, a popularity list of five: subjects off the list get recommendations as well."""
    rows = [(str(b), f"s{(b + d) % 60:02d}") for b in range(240) for d in range(3)]
    fact = spark.createDataFrame([(b, s) for b, s in rows], "transaction_id string, product_id string")
    products = spark.createDataFrame([(f"s{i:02d}", f"s{i:02d}") for i in range(60)], "product_id string, subcategory string")
    rules, _ = B.mine_rules(B.baskets(fact, products))
    got = B.recommend_all(B.rank_rules(rules), B.popularity(fact, products, 5), products, 3)
    assert got.select("subcategory").distinct().count() == 60


def test_long_itemsets_split_level_by_level(spark):
    items = [f"i{k}" for k in range(5)]
    from itertools import combinations

    sets = [(sorted(c), 10 - n) for n in range(1, 6) for c in combinations(items, n)]
    rules = B.all_rules(spark.createDataFrame(sets, "items array<string>, freq bigint"), 20, 0.0)
    assert rules.count() == sum(2 ** len(s) - 2 for s, _ in sets if len(s) > 1)
    assert rules.where(F.size(F.array_intersect("antecedents", "consequents")) > 0).count() == 0


def test_small_cohorts_stay(spark):
    fact = spark.createDataFrame([("a", 2000, "2000-05-01"), ("b", 2001, "2001-01-01")], "customer_id string, order_year int, d string")
    fact = fact.withColumn("order_date", F.col("d").cast("date"))
    assert {r["cohort"] for r in eda.cohort_retention(fact, 2000, 2001).collect()} == {2000, 2001}


def test_outcomes_go_by_date_and_skip_labelled(spark):
    events = spark.createDataFrame(
        [("a", "view", "2024-01-01 12:00:00"), ("a", "purchase", "2024-01-01 08:00:00"), ("b", "view", "2024-01-01 12:00:00"),
         ("c", "view", "2024-01-20 00:00:00")], "user_id string, event_type string, t string").withColumn("ts", F.col("t").cast("timestamp"))
    preds = events.where("event_type = 'view'").select(F.col("user_id").alias("customer_id"), F.col("ts").alias("predicted_at"))
    first = X.materialize_outcomes(preds, events, 7)
    assert {(r["customer_id"], r["churned"], str(r["outcome_date"])) for r in first.collect()} == {("a", False, "2024-01-20"), ("b", True, "2024-01-20")}
    again = X.materialize_outcomes(preds, events, 7, labelled=first.where("customer_id = 'a'"))
    assert [r["customer_id"] for r in again.collect()] == ["b"]


def test_stale_result_is_no_reason_to_retrain(spark):
    row = spark.createDataFrame([(10, 5, 0.5, True)], "n_features int, n_drifted int, drift_share double, dataset_drift boolean")
    at = lambda t: F.lit(t).cast("timestamp")
    fresh = X.retrain_decision(row, checked_at=at("2024-01-02 00:00:00"), now=at("2024-01-02 23:00:00")).first()
    stale = X.retrain_decision(row, checked_at=at("2024-01-02 00:00:00"), now=at("2024-01-03 01:00:00")).first()
    assert fresh["retrain"] and not stale["retrain"] and X.retrain_decision(row).first()["retrain"]
