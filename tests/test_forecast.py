"""Chosen change points, simulated bands and the backtest, against hand-worked cases."""

import datetime as dt

import numpy as np
import pytest

from vigil.operators import forecast as fc

FIRST = dt.date(2021, 1, 4)


def series(spark, ys, g="a", first=FIRST):
    return spark.createDataFrame([(g, first + dt.timedelta(days=i), y) for i, y in enumerate(ys)], "g string, ds date, y double")


def fit(ys, **kw):
    kw = {"horizon": 60, "weekly": 0, "yearly": 0, "n_changes": fc.N_CHANGES, "change_scale": fc.CHANGE_SCALE, **kw}
    return fc.fit_sparse(np.arange(len(ys), dtype=float), np.asarray(ys, float), np.ones(len(ys)), **kw)


def noise(n, scale, seed=1):
    return np.random.default_rng(seed).normal(0, scale, n)


def test_coordinate_descent_equals_the_optimum():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(40, 6))
    gram, target = a.T @ a, a.T @ rng.normal(size=40) * 3
    for penalty in (0.0, 2.0, 8.0, 1e3):
        d = fc.sparse_changes(gram, target, penalty, np.zeros(6))
        slope = gram @ d - target
        for x, g in zip(d, slope):  # the optimality condition of each coordinate
            assert abs(g + penalty * np.sign(x)) < 1e-5 if x else abs(g) <= penalty + 1e-6
    assert not fc.sparse_changes(gram, target, 1e3, np.zeros(6)).any()
    assert fc.soft_threshold(3.0, 1.0) == 2.0 and fc.soft_threshold(-3.0, 1.0) == -2.0 and fc.soft_threshold(0.5, 1.0) == 0.0


def test_two_slopes_have_few_changes():
    ys = [10 + i if i < 100 else 110 - 2 * (i - 100) for i in range(200)] + noise(200, 1.0)
    f = fit(ys)
    live = np.flatnonzero(np.abs(f["changes"]) > 1e-9)
    assert 1 <= len(live) <= 6 and len(f["changes"]) == 25
    # the slope falls by 3 a day near day 100
    day = f["unit"] / f["span"]
    assert (f["changes"].sum() * day) == pytest.approx(-3, abs=0.35)
    near = np.abs(f["at"] * f["span"] - 100) < 8
    assert np.abs(f["changes"][near]).sum() > 0.9 * np.abs(f["changes"]).sum()
    assert f["trend"][-1] == pytest.approx(110 - 2 * (259 - 100), abs=25)


def test_a_line_has_no_changes():
    f = fit([5 + 0.5 * i for i in range(120)] + noise(120, 2.0))
    assert (np.abs(f["changes"]) * f["unit"] / f["span"] < 0.05).all() and (f["changes"] == 0).sum() >= 20


def test_band_grows_with_the_distance():
    ys = [10 + i if i < 100 else 110 - 2 * (i - 100) for i in range(200)] + noise(200, 1.0)
    f = fit(ys)
    low, high = fc.simulated_band(f, 200, 0.95, 7)
    wide = high - low
    assert wide[259] > 2 * wide[200] > 0 and (np.diff(wide[200:]) > -0.2 * wide[200]).all()
    assert wide[0] == pytest.approx(2 * 1.96 * f["sigma"], rel=1e-3) and wide[200] == pytest.approx(wide[0], rel=0.2)
    again = fc.simulated_band(f, 200, 0.95, 7)
    assert (again[0] == low).all() and (fc.simulated_band(f, 200, 0.95, 8)[0][200:] != low[200:]).any()
    # without changes in the history the future has none
    f["changes"][:] = 0
    low, high = fc.simulated_band(f, 200, 0.95, 7)
    assert (high - low)[259] == pytest.approx((high - low)[200], rel=0.2)


def test_series_in_spark(spark):
    bent = [10 + i if i < 100 else 110 - 2 * (i - 100) for i in range(200)] + noise(200, 1.0) + 5 * np.sin(2 * np.pi * np.arange(200) / 7)
    df = series(spark, [float(y) for y in bent]).unionByName(series(spark, [3.0] * 10, "flat")).unionByName(series(spark, [4.0], "one"))
    df = df.unionByName(spark.createDataFrame([("a", None, 1.0), ("b", FIRST, None)], df.schema))
    got = fc.forecast_sparse_changepoint(df, ["g"], horizon=60).collect()
    by = {g: sorted((r for r in got if r.g == g), key=lambda r: r.ds) for g in ("a", "flat", "one", "b")}
    assert [len(by[g]) for g in ("a", "flat", "one", "b")] == [260, 70, 61, 0]
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in got)
    assert all(abs(r.yhat - 3) < 1e-3 for r in by["flat"]) and abs(by["one"][0].yhat - 4) < 1e-3
    a = by["a"]
    assert a[259].yhat_upper - a[259].yhat_lower > 1.5 * (a[200].yhat_upper - a[200].yhat_lower)
    assert max(abs(r.yhat - y) for r, y in zip(a, bent)) < 6
    more = fc.forecast_sparse_changepoint(df.repartition(3), ["g"], horizon=60).collect()
    assert sorted(map(str, more)) == sorted(map(str, got))


def test_backtest_by_hand(spark):
    # a line that jumps by 10 after day 50: forecasts from day 49 and before miss by 10 beyond it
    ys = [float(i) + (10.0 if i > 50 else 0.0) for i in range(60)]
    got = {r.horizon: r for r in fc.backtest_linear_weekly(series(spark, ys), ["g"], cutoffs=3, step=5, horizon=6, least_days=28).collect()}
    # cut-offs: days 54, 49, 44; the fit up to 49 and 44 is the line itself
    assert {h: r.n for h, r in got.items()} == {1: 3, 2: 3, 3: 3, 4: 3, 5: 3, 6: 2}  # 54 + 6 is past the end
    fit54 = np.polyfit(range(55), ys[:55], 1)
    for h in (1, 2, 6):
        cuts = [c for c in (54, 49, 44) if c + h < 60]
        off = [abs(ys[c + h] - (c + h)) for c in cuts if c != 54]
        if 54 in cuts:
            res = np.array(ys[:55]) - np.polyval(fit54, range(55))
            season = np.mean([x for i, x in enumerate(res) if i % 7 == (54 + h) % 7])
            off.append(abs(ys[54 + h] - np.polyval(fit54, 54 + h) - season))
        assert got[h].mae == pytest.approx(np.mean(off), abs=2e-4) and got[h].rmse == pytest.approx(np.sqrt(np.mean(np.square(off))), abs=2e-4)


def test_backtest_of_short_and_odd_series(spark):
    df = series(spark, [1.0] * 20).unionByName(series(spark, [1.0] * 90, "long")).unionByName(spark.createDataFrame([("long", None, 2.0), ("n", FIRST, None)], "g string, ds date, y double"))
    got = fc.backtest_linear_weekly(df, ["g"], cutoffs=5, step=20, horizon=3, least_days=28).collect()
    assert {(r.g, r.horizon, r.n, r.mae) for r in got} == {("long", h, 3, 0.0) for h in (1, 2, 3)}
    assert fc.backtest_linear_weekly(df.limit(0), ["g"]).count() == 0
