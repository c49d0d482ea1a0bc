"""Forecasts per series (F-5, F-5a, F-5b, F-11).

``forecast_linear_weekly`` is an open, SQL-expressible model: a least-squares trend in days
(``regr_slope``/``regr_intercept``), a weekly effect (mean residual per ISO weekday) and a normal
band from the standard deviation of what is left. Every series is one group of grouped
aggregations, so thousands of series cost the same few passes as one; nothing is collected.

``forecast_changepoint`` is the heavier decomposable model (piecewise-linear trend with change
points plus weekly and, over two years, yearly Fourier terms, ridge least squares); it runs per series in ``applyInPandas``.
A series is one row per day, so a group is bounded by the length of its calendar, not by the size
of the data behind it.

``forecast_sparse_changepoint`` chooses its change points: slope changes have a Laplace prior, so most are
exactly zero, and the band holds simulated future changes, so it grows with the distance.

``backtest_linear_weekly`` measures the open model: all cut-off days in one job, errors by horizon.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.joins import broadcast_if_bounded
from vigil.session import materialize, ship_package

HORIZON = 60     # fixed value: days forecast after the last observation
LEVEL = 0.95     # fixed value: width of the interval
YEARLY_FROM = 730  # fixed value: days of history from which a yearly season is fitted


def z_value(level: float) -> float:
    return NormalDist().inv_cdf(0.5 + level / 2.0)


def iso_weekday(ds: Column | str) -> Column:
    ds = F.col(ds) if isinstance(ds, str) else ds
    return (F.weekday(ds) + 1).cast("bigint")


def to_series(df: DataFrame, keys: Sequence[str], date: str, metrics: Sequence[str],
              metric_col: str = "metric", value_col: str = "y") -> DataFrame:
    """Wide metrics -> long series (keys..., metric, ds, y) without a shuffle."""
    long = df.unpivot([*keys, date], list(metrics), metric_col, value_col)
    return long.withColumnRenamed(date, "ds").select(*keys, metric_col, "ds", F.col(value_col).cast("double").alias(value_col))


def future_spine(series: DataFrame, keys: Sequence[str], ds: str = "ds", periods: int = HORIZON,
                 include_history: bool = True) -> DataFrame:
    """(keys..., ds): the history dates plus ``periods`` days after each series' last date."""
    keys = list(keys)
    last = series.groupBy(*keys).agg(F.max(ds).alias("__last"))
    fut = last.select(*keys, F.explode(F.sequence(F.date_add("__last", 1), F.date_add("__last", periods)))
                      .alias(ds))
    if not include_history:
        return fut
    return series.select(*keys, ds).distinct().unionByName(fut)


def forecast_linear_weekly(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y",
                           horizon: int = HORIZON, level: float = LEVEL, digits: int = 4, few_series: bool = False) -> DataFrame:
    """(keys..., ds, yhat, yhat_lower, yhat_upper) for the history and ``horizon`` future days. ``few_series``
    (a top-k) sends the parameters to the rows instead of shuffling them."""
    keys = list(keys)
    small = F.broadcast if few_series else (lambda df: df)
    z = z_value(level)
    s = series.select(*keys, ds, F.col(y).cast("double").alias("__y"))
    t = F.unix_date(F.col(ds)).cast("double")
    params = s.groupBy(*keys).agg(F.regr_slope("__y", t).alias("__b"), F.regr_intercept("__y", t).alias("__a"))
    resid = (s.join(small(params), keys)
             .select(*keys, iso_weekday(ds).alias("__wd"), (F.col("__y") - (F.col("__a") + F.col("__b") * t))
                     .alias("__r")))
    season = resid.groupBy(*keys, "__wd").agg(F.avg("__r").alias("__s"))
    sigma = (resid.join(small(season), [*keys, "__wd"])
             .groupBy(*keys).agg(F.stddev_samp(F.col("__r") - F.col("__s")).alias("__sigma")))
    spine = future_spine(s, keys, ds, horizon).withColumn("__wd", iso_weekday(ds))
    out = (spine.join(small(params), keys).join(small(season), [*keys, "__wd"], "left").join(small(sigma), keys, "left"))
    yhat = F.col("__a") + F.col("__b") * F.unix_date(F.col(ds)).cast("double") + F.coalesce(F.col("__s"), F.lit(0.0))
    band = F.lit(z) * F.col("__sigma")
    return out.select(*keys, ds, F.round(yhat, digits).alias("yhat"),
                      F.round(yhat - band, digits).alias("yhat_lower"),
                      F.round(yhat + band, digits).alias("yhat_upper"))


def forecast_chart_data(series: DataFrame, forecast: DataFrame, keys: Sequence[str], ds: str = "ds",
                        y: str = "y") -> DataFrame:
    """Plot-ready rows: every forecast date with the observed value (null in the future)."""
    keys = list(keys)
    obs = series.select(*keys, ds, F.col(y).cast("double").alias(y))
    return forecast.join(obs, [*keys, ds], "left")


# ---- change-point model (per series, applyInPandas) ---------------------------------------------

def _changepoint_fit(pdf: pd.DataFrame, keys: list[str], ds: str, y: str, horizon: int, z: float,
                     n_changepoints: int, fourier_order: int, ridge: float, yearly_order: int) -> pd.DataFrame:
    pdf = pdf.sort_values(ds)
    d = pd.to_datetime(pdf[ds]).to_numpy(dtype="datetime64[D]").astype(np.int64).astype(float)
    yy = pdf[y].astype(float).to_numpy()
    wts = pdf["__n"].astype(float).to_numpy()   # observations behind each daily mean
    n = len(d)
    future = np.arange(d[-1] + 1, d[-1] + horizon + 1, dtype=float)
    allt = np.concatenate([d, future])
    t0, span = d[0], max(d[-1] - d[0], 1.0)
    tt = (allt - t0) / span
    # change points evenly over the first 80 % of the history
    k = min(n_changepoints, max(n - 2, 0))
    cps = np.linspace(0, 0.8, k + 2)[1:-1] if k > 0 else np.array([])
    cols = [np.ones_like(tt), tt] + [np.maximum(tt - c, 0.0) for c in cps]
    for j in range(1, fourier_order + 1):
        ang = 2 * np.pi * j * allt / 7.0
        cols += [np.sin(ang), np.cos(ang)]
    if d[-1] - d[0] >= YEARLY_FROM:
        for j in range(1, yearly_order + 1):
            ang = 2 * np.pi * j * allt / 365.25
            cols += [np.sin(ang), np.cos(ang)]
    X = np.column_stack(cols)
    Xh = X[:n]
    pen = np.full(X.shape[1], ridge)
    pen[:2] = 0.0
    xtw = Xh.T * wts
    beta = np.linalg.solve(xtw @ Xh + np.diag(pen) + 1e-9 * np.eye(X.shape[1]), xtw @ yy)
    fit = X @ beta
    res = yy - fit[:n]
    dof = wts.sum() - 1.0
    sigma = float(np.sqrt((wts * res * res).sum() / dof)) if dof > 0 else float("nan")
    out = pd.DataFrame({ds: pd.to_datetime(allt, unit="D").date,
                        "yhat": fit, "yhat_lower": fit - z * sigma, "yhat_upper": fit + z * sigma})
    for key in keys:
        out[key] = pdf[key].iloc[0]
    return out[[*keys, ds, "yhat", "yhat_lower", "yhat_upper"]]


def forecast_changepoint(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y",
                         horizon: int = HORIZON, level: float = LEVEL, n_changepoints: int = 25,
                         fourier_order: int = 3, ridge: float = 1.0, yearly_order: int = 10) -> DataFrame:
    """Like ``forecast_linear_weekly``, with change points in the trend and, for series of two years or more,
    a yearly season."""
    keys = list(keys)
    z = z_value(level)
    ship_package(series.sparkSession)   # the per-series fit runs in the Python workers
    schema_keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in series.schema.fields if f.name in keys)
    schema = f"{schema_keys}, {ds} date, yhat double, yhat_lower double, yhat_upper double"
    # one row per (series, day) before grouping: a group holds at most the days of its calendar,
    # whatever the number of raw rows behind them (daily mean, weighted by its count)
    s = series.groupBy(*keys, ds).agg(F.avg(F.col(y).cast("double")).alias(y), F.count(F.lit(1)).alias("__n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return _changepoint_fit(pdf, keys, ds, y, horizon, z, n_changepoints, fourier_order, ridge, yearly_order)

    return s.groupBy(*keys).applyInPandas(fit, schema=schema)


# ---- sparse change points (per series, applyInPandas) ---------------------------------------------

CHANGE_SCALE = 0.05   # fixed value: scale of the slope changes' Laplace prior, as a share of the largest value
SEASON_SCALE = 10.0   # fixed value: scale of the season's normal prior
N_CHANGES, CHANGE_RANGE = 25, 0.8  # fixed values: possible change points, over this first part of the history
SAMPLES = 1000        # fixed value: simulated futures


def soft_threshold(x: float, by: float) -> float:
    return np.sign(x) * max(abs(x) - by, 0.0)


def sparse_changes(gram: np.ndarray, target: np.ndarray, penalty: float, start: np.ndarray, sweeps: int = 500, tolerance: float = 1e-10) -> np.ndarray:
    """The minimum of half d'Gd - t'd + penalty * sum|d| by coordinate descent."""
    d = start.copy()
    scale = np.diag(gram)
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(scale > 1e-12):
            new = soft_threshold(target[j] - gram[j] @ d + scale[j] * d[j], penalty) / scale[j]
            moved, d[j] = max(moved, abs(new - d[j])), new
        if moved < tolerance:
            break
    return d


def _columns(days: np.ndarray, weekly: int, yearly: int) -> np.ndarray:
    """The season's columns: sines and cosines of the week and, if ``yearly``, of the year."""
    waves = [2 * np.pi * j * days / p for p, n in ((7.0, weekly), (365.25, yearly)) for j in range(1, n + 1)]
    return np.column_stack([f(w) for w in waves for f in (np.sin, np.cos)]) if waves else np.zeros((len(days), 0))


def fit_sparse(days: np.ndarray, y: np.ndarray, weight: np.ndarray, horizon: int, weekly: int, yearly: int, n_changes: int, change_scale: float) -> dict:
    """The fit of one series: ``trend`` and ``season`` over the history and ``horizon`` days more, the noise's ``sigma``, the
    ``changes`` of slope (a share of the history's length and of the largest value) at ``at``, and the units of both."""
    every = np.concatenate([days, np.arange(days[-1] + 1, days[-1] + horizon + 1)])
    span, unit = max(days[-1] - days[0], 1.0), max(np.abs(y).max(), 1e-12)
    t, n = (every - days[0]) / span, len(days)
    k = min(n_changes, max(n - 2, 0))
    at = np.linspace(0, CHANGE_RANGE, k + 1)[1:] if k else np.zeros(0)
    season = _columns(every, weekly, yearly if days[-1] - days[0] >= YEARLY_FROM else 0)
    free = np.column_stack([np.ones_like(t), t, season])
    bends = np.maximum(t[:, None] - at, 0.0)
    z, c, target = free[:n], bends[:n], y / unit
    changes, sigma2 = np.zeros(k), None
    for _ in range(20):  # the noise and the changes in turn
        prior = np.diag(np.r_[0.0, 0.0, np.full(season.shape[1], (sigma2 or 1e-2) / SEASON_SCALE**2)]) + 1e-10 * np.eye(free.shape[1])
        solve = np.linalg.solve((z.T * weight) @ z + prior, z.T * weight)
        if sigma2 is None:
            r = target - z @ (solve @ target)
            sigma2 = max(float((weight * r * r).sum() / weight.sum()), 1e-10)
        left, of = c - z @ (solve @ c), target - z @ (solve @ target)
        new = sparse_changes((c.T * weight) @ left, (c.T * weight) @ of, sigma2 / change_scale, changes)
        r = of - left @ new
        before, sigma2 = sigma2, max(float((weight * r * r).sum() / max(weight.sum() - 1, 1.0)), 1e-10)
        done = np.abs(new - changes).max(initial=0) < 1e-9 and abs(sigma2 - before) < 1e-6 * before
        changes = new
        if done:
            break
    beta = solve @ (target - c @ changes)
    return {"days": every, "trend": unit * (free[:, :2] @ beta[:2] + bends @ changes), "season": unit * (season @ beta[2:]), "sigma": unit * sigma2**0.5,
            "changes": changes, "at": at, "unit": unit, "span": span}


def simulated_band(fit: dict, n: int, level: float, seed: int, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) distances from the fit: the noise's quantiles over the history; beyond it those of simulated futures, in which
    slopes change as often as change points lie in the history, by as much as they did on average."""
    rng = np.random.Generator(np.random.PCG64(seed))
    horizon = len(fit["days"]) - n
    z = z_value(level) * fit["sigma"]
    low, high = np.full(n + horizon, -z), np.full(n + horizon, z)
    if horizon:
        rate = min(1.0, len(fit["at"]) / max(fit["span"], 1.0))
        size = np.abs(fit["changes"]).mean() if len(fit["changes"]) else 0.0
        turns = rng.laplace(0.0, size + 1e-12, (samples, horizon)) * (rng.random((samples, horizon)) < rate)
        slope = np.cumsum(turns, axis=1) * fit["unit"] / fit["span"]  # a day's step
        paths = np.cumsum(slope, axis=1) + rng.normal(0.0, fit["sigma"], (samples, horizon))
        low[n:], high[n:] = np.quantile(paths, [(1 - level) / 2, (1 + level) / 2], axis=0)
    return low, high


def forecast_sparse_changepoint(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", horizon: int = HORIZON, level: float = LEVEL,
                                weekly: int = 3, yearly: int = 10, n_changes: int = N_CHANGES, change_scale: float = CHANGE_SCALE) -> DataFrame:
    """(keys..., ds, yhat, yhat_lower, yhat_upper, trend) for the history and ``horizon`` future days. Rows with a null day or value take
    no part; simulations are seeded by the series' keys, so a series gives the same band in every run."""
    keys = list(keys)
    ship_package(series.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in series.schema.fields}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"`{ds}` date", "yhat double", "yhat_lower double", "yhat_upper double", "trend double"])
    daily = (series.where(F.col(ds).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, ds)
             .agg(F.avg(F.col(y).cast("double")).alias("__y"), F.count(F.lit(1)).alias("__n")))
    seed = F.xxhash64(*[F.col(k).cast("string") for k in keys]) if keys else F.lit(0).cast("long")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ds)
        days = pd.to_datetime(pdf[ds]).to_numpy(dtype="datetime64[D]").astype(np.int64).astype(float)
        f = fit_sparse(days, pdf["__y"].to_numpy(float), pdf["__n"].to_numpy(float), horizon, weekly, yearly, n_changes, change_scale)
        low, high = simulated_band(f, len(days), level, int(pdf["__seed"].iloc[0]) & (2**63 - 1))
        yhat = f["trend"] + f["season"]
        out = pd.DataFrame({ds: pd.to_datetime(f["days"], unit="D").date, "yhat": yhat, "yhat_lower": yhat + low, "yhat_upper": yhat + high, "trend": f["trend"]})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, ds, "yhat", "yhat_lower", "yhat_upper", "trend"]]

    return daily.withColumn("__seed", seed).groupBy(*keys).applyInPandas(fit, schema=schema)


# ---- rolling-origin backtest -----------------------------------------------------------------------

def backtest_linear_weekly(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", cutoffs: int = 4, step: int = 30, horizon: int = HORIZON,
                           least_days: int = 28, level: float = LEVEL, digits: int = 4) -> DataFrame:
    """(keys..., horizon, n, mae, rmse, coverage): how far ``forecast_linear_weekly`` was off ``horizon`` days after a cut-off, over the
    cut-offs of each series: ``cutoffs`` days, ``step`` days apart, the last one ``step`` days before the series' end. Each is fitted to
    what lies up to it, if the history has ``least_days`` days by then. ``coverage`` is the share of values within the band.

    A row is repeated for each cut-off of its series that it is history or horizon of, so all fits are one job whose groups are
    (series, cut-off).
    """
    keys = list(keys)
    span = materialize(series.where(F.col(ds).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(F.min(ds).alias("__first"), F.max(ds).alias("__last")))
    days = F.transform(F.sequence(F.lit(1), F.lit(cutoffs)), lambda i: F.date_sub("__last", i * step))
    cuts = F.filter(days, lambda c: F.date_diff(c, F.col("__first")) + 1 >= least_days)
    plan = span.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.explode(cuts).alias("__cut"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], F.lit(True))
    rows = series.where(F.col(ds).isNotNull() & F.col(y).isNotNull()).select(*keys, ds, F.col(y).cast("double").alias(y))
    rows = rows.join(broadcast_if_bounded(plan), same & (F.col(ds) <= F.date_add("__cut", horizon))).select(*keys, ds, y, "__cut")
    rows = materialize(rows)
    train, later = rows.where(F.col(ds) <= F.col("__cut")), rows.where(F.col(ds) > F.col("__cut"))
    keys_cut = [*keys, "__cut"]
    made = forecast_linear_weekly(train, keys_cut, ds, y, horizon, level, digits=9).where(F.col(ds) > F.col("__cut"))
    both = later.join(made, [*keys_cut, ds])
    off = F.col(y) - F.col("yhat")
    inside = F.col(y).between(F.col("yhat_lower"), F.col("yhat_upper"))
    return both.groupBy(*keys, F.date_diff(ds, "__cut").cast("long").alias("horizon")).agg(
        F.count("*").alias("n"), F.round(F.avg(F.abs(off)), digits).alias("mae"), F.round(F.sqrt(F.avg(off * off)), digits).alias("rmse"),
        F.round(F.avg(F.when(inside, 1.0).otherwise(0.0)), digits).alias("coverage"))
