"""Every registered query with an oracle matches DuckDB on the sf0.001 tables (order-insensitive)."""

import math

import pytest

import __spark_entry__ as E

from .conftest import SF001

ORACLE = E.oracle_sql()


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    import numpy as np
    if isinstance(v, np.ndarray):
        return tuple(_norm(x) for x in v.tolist())
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["subcategory", "revenue", "orders"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = duck.execute(ORACLE[name]).fetchdf()
    cg, rg = _rows(got)
    cw, rw = _rows(want)
    assert cg == cw
    assert len(rg) == len(rw)
    assert rg == rw


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(ORACLE) <= set(qs)
    assert all(callable(f) for f in qs.values())
