"""Forecast models: coordinate descent, holiday windows, planted trend changes, both models' errors."""

import numpy as np
import pandas as pd
import pytest

from bazaar.operators import forecasting as FC

SCHEMA = "subcategory string, month date, total_revenue double"


def _rows(name, months, bend=None, festival=0.0, seed=1):
    rng = np.random.default_rng(seed)
    ds = pd.Series(pd.date_range("1995-01-01", periods=months, freq="MS"))
    t = np.arange(months)
    log = 8 + 0.01 * t + 0.1 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 0.01, months)
    if bend is not None:
        log += 0.05 * np.maximum(t - bend, 0)
    log += festival * FC.holiday_share(ds, FC.DIWALI)
    return [(name, d.date(), float(np.expm1(v))) for d, v in zip(ds, log, strict=True)]


@pytest.mark.parametrize("penalty", [0.01, 1.0, 20.0, 1e6])
def test_lasso_is_optimal(penalty):
    rng = np.random.default_rng(0)
    z = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6))
    z[:, 5] = 0.0
    y = z @ np.array([2.0, 0, 0, -1, 0, 0]) + rng.normal(size=40)
    b = FC.lasso(z, y, penalty, rounds=50_000)
    slope = z.T @ (y - z @ b)  # the penalty's sign where a coefficient is, within the penalty elsewhere
    assert np.allclose(slope[b != 0], penalty * np.sign(b[b != 0]), atol=1e-5)
    assert (np.abs(slope[b == 0]) <= penalty + 1e-6).all()
    assert penalty < 1e6 or not b.any()


def test_holiday_window_is_counted_into_months():
    months = pd.Series(pd.to_datetime(["2024-09-01", "2024-10-01", "2024-11-01", "2030-11-01"]))
    got = FC.holiday_share(months, ("2024-11-01",))  # 25 October to 4 November
    assert np.allclose(got, [0, 7 / 11, 4 / 11, 0])


def test_planted_change_is_found(spark):
    rows = _rows("bent", 72, bend=36) + _rows("line", 72, seed=2)
    got = FC.trend_changes(spark.createDataFrame(rows, SCHEMA)).toPandas()
    bent, line = got[got["subcategory"] == "bent"], got[got["subcategory"] == "line"]
    near = (pd.to_datetime(bent["month"]) - pd.Timestamp("1998-01-01")).abs().dt.days < 130
    assert bent.loc[near, "slope_change"].sum() > 0.8 * bent["slope_change"].abs().sum()
    assert abs(bent["slope_change"].sum() - 0.6) < 0.1 and line["slope_change"].abs().sum() < 0.1
    assert np.allclose(bent["slope_after"] - bent["slope_before"], bent["slope_change"])


def test_full_model_beats_a_line(spark):
    rows = _rows("bent", 72, bend=36, festival=0.4) + _rows("plain", 72, seed=3) + _rows("short", 11)
    got = {r["subcategory"]: r for r in FC.compare_models(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {"bent", "plain"}
    assert got["bent"]["wmape_full"] < 0.05 < got["bent"]["wmape_line"] and got["plain"]["wmape_full"] < 0.05


def test_band_widens_with_the_horizon(spark):
    fc = FC.forecast(spark.createDataFrame(_rows("bent", 60, bend=30), SCHEMA)).where("kind = 'forecast'").toPandas().sort_values("ds")
    width = np.log1p(fc["yhat_upper"].to_numpy()) - np.log1p(fc["yhat_lower"].to_numpy())
    assert (np.diff(width) > 0).all() and (fc["yhat_lower"] < fc["yhat"]).all()


def test_defined_results(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert FC.forecast(empty).count() == 0 and FC.trend_changes(empty).count() == 0
    zeros = [("z", d, 0.0 if i % 2 else -1.0) for i, (_, d, _) in enumerate(_rows("z", 24))]
    got = FC.forecast(spark.createDataFrame(zeros, SCHEMA)).toPandas()
    assert len(got) == 36 and np.isfinite(got["yhat"]).all() and np.abs(got["yhat"]).max() < 1e-6
    assert FC.trend_changes(spark.createDataFrame(zeros, SCHEMA)).count() == 0
