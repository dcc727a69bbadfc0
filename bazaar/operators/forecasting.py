"""Monthly demand series and per-subcategory forecasts.

M15 is a grouped aggregate.  M16 fits one small model per subcategory with ``groupBy(subcategory).applyInPandas``: each
group is one monthly series (one row per month), so a task never holds more than that.

The model is additive in the log, so its parts multiply: a piecewise-linear trend, yearly Fourier terms and one regressor
per holiday, the part of its window of days (from 7 before to 3 after a date) that falls in a month.  The slope may
change at ``changepoints`` places evenly spread over the first ``CHANGE_RANGE`` of the months of the fit; each change has
a Laplace prior of scale ``prior``, so most of them come out as exactly zero (lasso by coordinate descent).  With
``changepoints=0`` the trend is one line.

Defined results: series under ``min_months`` rows give none; negative revenue counts as 0; months without a row are
left out of the fit; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORECAST_SCHEMA = ("subcategory string, ds date, kind string, y double, yhat double, yhat_lower double, "
                   "yhat_upper double")
CHANGE_SCHEMA = "subcategory string, month date, slope_before double, slope_after double, slope_change double"

# The days of the festival, in the years of the original data and in those of the test tables.
DIWALI = (
    "1992-10-25", "1993-11-13", "1994-11-03", "1995-10-23", "1996-11-10", "1997-10-30", "1998-10-19", "1999-11-07",
    "2000-10-26", "2001-11-14",
    "2015-11-11", "2016-10-30", "2017-10-19", "2018-11-07", "2019-10-27", "2020-11-14", "2021-11-04", "2022-10-24",
    "2023-11-12", "2024-11-01",
)
HOLIDAYS: dict[str, tuple[str, ...]] = {"diwali": DIWALI}
WINDOW = (-7, 3)  # days of a holiday's window, both included
CHANGEPOINTS, CHANGE_RANGE, PRIOR = 25, 0.8, 0.05


def monthly_series(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per (month, subcategory), date and subcategory non-null."""
    by = fact.where(F.col("order_date").isNotNull()).groupBy(
        "product_id", F.trunc("order_date", "month").alias("month")).agg(F.sum("final_amount_inr").alias("_r"))
    j = by.join(products.select("product_id", "subcategory").where(F.col("subcategory").isNotNull()), "product_id")
    return (j.groupBy("month", "subcategory").agg(F.sum("_r").cast("double").alias("total_revenue"))
            .orderBy("subcategory", "month"))


def _elapsed(months: pd.Series, t0: pd.Timestamp) -> np.ndarray:
    m = pd.to_datetime(months)
    return ((m.dt.year - t0.year) * 12 + (m.dt.month - t0.month)).to_numpy(dtype=float)


def holiday_share(months: pd.Series, dates: tuple[str, ...], window: tuple[int, int] = WINDOW) -> np.ndarray:
    """The part of a holiday's window of days that falls in each month."""
    offsets = range(window[0], window[1] + 1)
    days = pd.DatetimeIndex([pd.Timestamp(d) + pd.Timedelta(days=k) for d in dates for k in offsets])
    per = days.to_period("M").value_counts() / len(offsets)
    return pd.to_datetime(months).dt.to_period("M").map(per).fillna(0.0).to_numpy(dtype=float)


def _base(months: pd.Series, t0: pd.Timestamp, holidays: dict[str, tuple[str, ...]], order: int = 3) -> np.ndarray:
    """Columns without a lasso: level, slope a year, Fourier terms, holidays."""
    t = _elapsed(months, t0)
    cols = [np.ones_like(t), t / 12.0]
    ang = 2 * np.pi * (pd.to_datetime(months).dt.month.to_numpy(dtype=float) - 1) / 12.0
    for k in range(1, order + 1):
        cols += [np.sin(k * ang), np.cos(k * ang)]
    return np.column_stack(cols + [holiday_share(months, d) for d in holidays.values()])


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 2000, settled: float = 1e-10) -> np.ndarray:
    """Coefficients of least |y - z b|^2 / 2 + penalty * |b|_1, one coordinate after another until none moves."""
    b, left, norm = np.zeros(z.shape[1]), y.astype(float).copy(), (z * z).sum(axis=0)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(norm > 1e-12):
            pull = z[:, j] @ left + norm[j] * b[j]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / norm[j]
            if new != b[j]:
                left -= z[:, j] * (new - b[j])
                moved, b[j] = max(moved, abs(new - b[j]) * norm[j] ** 0.5), new
        if moved < settled:
            break
    return b


class Fit:
    """One series' model: ``beta`` of the base columns, slope changes ``delta`` a year at ``knots`` (months from ``t0``)."""

    def __init__(self, months: pd.Series, y: np.ndarray, holidays: dict[str, tuple[str, ...]], changepoints: int, prior: float, ridge: float):
        self.t0, self.holidays = pd.Timestamp(months.iloc[0]), holidays
        t = _elapsed(months, self.t0)
        seen = int(np.floor(len(t) * CHANGE_RANGE))
        places = np.unique(np.linspace(0, seen - 1, min(changepoints, max(seen - 1, 0)) + 1).round().astype(int))[1:]
        self.knots, self.months = t[places], pd.to_datetime(months).iloc[places]
        self.span = max(t[-1] / 12.0, 1 / 12.0)
        x, z = _base(months, self.t0, holidays), self._hinges(t)
        inverse = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T)
        off = lambda v: v - x @ (inverse @ v)  # noqa: E731  what the base columns leave
        zo, yo = off(z), off(y)
        self.delta = np.zeros(len(self.knots))
        if len(self.knots) and len(yo) > 2:
            # the noise is taken from second differences, in which a change of the trend is one of many; a change is
            # measured over the whole span, as its prior is
            noise = (np.diff(yo, 2) ** 2).mean() / 6
            self.delta = lasso(zo / self.span, yo, noise / prior) / self.span
        spread = (yo - zo @ self.delta).std()
        self.beta, self.spread = inverse @ (y - z @ self.delta), float(spread)

    def _hinges(self, t: np.ndarray) -> np.ndarray:
        return np.maximum(t[:, None] - self.knots[None, :], 0.0) / 12.0

    def predict(self, months: pd.Series) -> np.ndarray:
        return _base(months, self.t0, self.holidays) @ self.beta + self._hinges(_elapsed(months, self.t0)) @ self.delta

    def deviation(self, ahead: np.ndarray) -> np.ndarray:
        """Of a forecast so many months ahead: the noise, and slope changes as frequent and large as those of the fit."""
        size = np.abs(self.delta).mean() if len(self.delta) else 0.0
        often = len(self.knots) / max(self.span * 12 * CHANGE_RANGE, 1.0)
        reach = np.array([(np.arange(1, int(h) + 1) ** 2).sum() for h in ahead]) / 144.0
        return np.sqrt(self.spread**2 + often * 2 * size**2 * reach)


def _fit(pdf: pd.DataFrame, holdout: int, refit_full: bool, **model) -> tuple[Fit, pd.DataFrame]:
    train = pdf.iloc[:-holdout] if holdout and not refit_full else pdf  # quirk Q16: fit on train rows only
    return Fit(train["month"], np.log1p(train["total_revenue"].to_numpy(dtype=float).clip(min=0)), **model), train


def _fit_predict(pdf: pd.DataFrame, horizon: int, holdout: int, min_months: int, refit_full: bool, **model) -> pd.DataFrame:
    pdf = pdf.sort_values("month")
    if len(pdf) < min_months:
        return pd.DataFrame(columns=["subcategory", "ds", "kind", "y", "yhat", "yhat_lower", "yhat_upper"])
    sub = pdf["subcategory"].iloc[0]
    fit, train = _fit(pdf, holdout, refit_full, **model)
    last = pd.Timestamp(train["month"].iloc[-1])
    future = pd.Series(pd.date_range(last + pd.offsets.MonthBegin(1), periods=horizon, freq="MS"))
    end = _elapsed(train["month"].iloc[-1:], fit.t0)[0]
    out = []
    for kind, months, yy in [("history", pdf["month"], pdf["total_revenue"].to_numpy(dtype=float)),
                             ("forecast", future, np.full(len(future), np.nan))]:
        mu = fit.predict(months)
        dev = 1.96 * fit.deviation(np.maximum(_elapsed(months, fit.t0) - end, 0))
        out.append(pd.DataFrame({"subcategory": sub, "ds": pd.to_datetime(months).dt.date, "kind": kind, "y": yy,
                                 "yhat": np.expm1(mu), "yhat_lower": np.expm1(mu - dev), "yhat_upper": np.expm1(mu + dev)}))
    res = pd.concat(out, ignore_index=True)
    # rows of the hold-out keep their actual y so WMAPE can be computed from the output
    hold = set(pd.to_datetime(pdf["month"].iloc[-holdout:]).dt.date) if holdout else set()
    res.loc[(res["kind"] == "history") & res["ds"].isin(hold), "kind"] = "holdout"
    return res


def _model(changepoints: int, holidays: dict[str, tuple[str, ...]] | None, prior: float, ridge: float) -> dict:
    return {"changepoints": changepoints, "holidays": HOLIDAYS if holidays is None else holidays, "prior": prior, "ridge": ridge}


def forecast(series: DataFrame, horizon: int = 12, holdout: int = 3, min_months: int = 12, ridge: float = 1e-3,
             refit_full: bool = False, changepoints: int = CHANGEPOINTS, holidays: dict[str, tuple[str, ...]] | None = None,
             prior: float = PRIOR) -> DataFrame:
    """Per-subcategory fit (>= 12 months, else skipped), last ``holdout`` rows held out (quirk Q17),
    history fit + hold-out + ``horizon`` months after the last row of the fit, with an approximate 95 % band.

    As the fit ends before the hold-out (quirk Q16), the first forecast months are those of the hold-out; with
    ``refit_full`` the fit has all rows and the forecast begins after them."""
    model = _model(changepoints, holidays, prior, ridge)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return _fit_predict(pdf, horizon, holdout, min_months, refit_full, **model)

    return series.groupBy("subcategory").applyInPandas(fn, FORECAST_SCHEMA)


def trend_changes(series: DataFrame, holdout: int = 3, min_months: int = 12, ridge: float = 1e-3, refit_full: bool = False,
                  changepoints: int = CHANGEPOINTS, holidays: dict[str, tuple[str, ...]] | None = None, prior: float = PRIOR) -> DataFrame:
    """The months at which a series' trend changes, slopes as log growth a year."""
    model = _model(changepoints, holidays, prior, ridge)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in CHANGE_SCHEMA.split(", ")]
        pdf = pdf.sort_values("month")
        if len(pdf) < min_months:
            return pd.DataFrame(columns=names)
        fit, _ = _fit(pdf, holdout, refit_full, **model)
        after = fit.beta[1] + np.cumsum(fit.delta)
        out = pd.DataFrame({"subcategory": pdf["subcategory"].iloc[0], "month": fit.months.dt.date.to_numpy(),
                            "slope_before": after - fit.delta, "slope_after": after, "slope_change": fit.delta}, columns=names)
        return out[np.abs(fit.delta) > 1e-9]

    return series.groupBy("subcategory").applyInPandas(fn, CHANGE_SCHEMA)


def compare_models(series: DataFrame, holdout: int = 3) -> DataFrame:
    """Hold-out WMAPE of each series by the full model and by one line without holidays."""
    full = wmape(forecast(series, holdout=holdout)).select("subcategory", F.col("wmape").alias("wmape_full"))
    line = wmape(forecast(series, holdout=holdout, changepoints=0, holidays={})).select("subcategory", F.col("wmape").alias("wmape_line"))
    return full.join(line, "subcategory")


def wmape(fc: DataFrame) -> DataFrame:
    """WMAPE per series on the hold-out rows (inf when actuals sum to 0), plus mean / median across series."""
    h = fc.where(F.col("kind") == "holdout")
    per = h.groupBy("subcategory").agg(
        F.when(F.sum(F.abs("y")) == 0, F.lit(float("inf"))).otherwise(
            F.sum(F.abs(F.col("y") - F.col("yhat"))) / F.sum(F.abs("y"))).alias("wmape"))
    return per.select("subcategory", "wmape", F.avg("wmape").over(_all()).alias("mean_wmape"),
                      F.percentile("wmape", F.lit(0.5)).over(_all()).alias("median_wmape"))


def next_month_summary(fc: DataFrame) -> DataFrame:
    """The first month after the rows of the fit, per subcategory."""
    f = fc.where(F.col("kind") == "forecast")
    return f.groupBy("subcategory").agg(F.min_by(F.struct("ds", "yhat", "yhat_lower", "yhat_upper"), "ds").alias("n")
                                        ).select("subcategory", "n.*")


def _all():
    from pyspark.sql.window import Window
    return Window.partitionBy()  # one row per series
