"""Lines meet products without being sorted, and brands are summed without wide sums by product."""

from __future__ import annotations

from decimal import Decimal

import pytest

from bazaar.operators import eda, kpis

LINES = [(1, 10, 7, "5.00", "1.0", "2.0"), (1, 10, 7, "5.00", "1.0", "2.0"), (2, 10, 8, "2.50", None, "3.0"), (3, None, 9, "1.00", "4.0", None),
         (4, 11, 5, "9.00", "1.0", "1.0"), (5, 11, None, "9.00", "1.0", "1.0"), (6, None, 7, None, "2.0", "2.0")]
PRODUCTS = [(7, "a", "X"), (8, "a", "Y"), (8, "a", "Y"), (9, "b", None), (5, None, "X"), (None, "b", "X")]


@pytest.fixture()
def tables(spark):
    d = lambda x: None if x is None else Decimal(x)
    fact = spark.createDataFrame([(*r[:3], *map(d, r[3:])) for r in LINES], "transaction_id long, customer_id long, product_id long, "
                                 "final_amount_inr decimal(22,6), discount_percent decimal(7,2), product_rating decimal(2,1)")
    return fact, spark.createDataFrame(PRODUCTS, "product_id long, subcategory string, brand string")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_popular_subcategories(tables):
    out = kpis.popular_subcategories(*tables)
    assert [tuple(r) for r in out.collect()] == [("a", 3, 1, 15.0 / 1e6), ("b", 1, 0, 1.0 / 1e6)]
    assert "ShuffledHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)


def test_top_brands(tables):
    out = eda.top_brands(*tables)
    assert [tuple(r) for r in out.collect()] == [("X", 19.0 / 1e9, 5 / 4, 7 / 4), ("Y", 5.0 / 1e9, None, 3.0), (None, 1.0 / 1e9, 4.0, None)]
    plan = _plan(out)
    assert "ShuffledHashJoin" in plan and "keys=[product_id" not in plan
