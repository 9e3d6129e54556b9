"""Order search and seasonal models against numpy regressions and series of known shape."""

import datetime

import numpy as np
import pytest

from shelfwise.operators import forecast, metrics, timeseries


def series(spark, **values):
    start = datetime.date(2018, 1, 1)
    rows = [(name, start + datetime.timedelta(days=i), float(v)) for name, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series string, period date, value double")


def simulated(n=1500):
    draw = np.random.default_rng(1)
    e = draw.standard_normal(n)
    ar = np.zeros(n)
    for t in range(2, n):
        ar[t] = 0.5 * ar[t - 1] - 0.4 * ar[t - 2] + e[t]
    return {"ar": 50 + ar, "ima": np.cumsum(e[1:] + 0.7 * e[:-1]), "white": 9 + draw.standard_normal(n)}


def variance_by_regression(ys, p, d, q, top, most_d):
    """Mean squared residual of one order: long autoregression, then least squares on lags and lagged shocks."""
    z = np.diff(ys, d) if d else ys - ys.mean()
    long, n = top + 4, len(ys) - most_d - top - (top + 4)
    lag = lambda v, k: v[len(v) - n - k : len(v) - k]
    phi = np.linalg.lstsq(np.column_stack([lag(z, k) for k in range(1, long + 1)]), lag(z, 0), rcond=None)[0]
    shock = lambda j: lag(z, j) - np.column_stack([lag(z, j + k) for k in range(1, long + 1)]) @ phi
    x = [lag(z, i) for i in range(1, p + 1)] + [shock(j) for j in range(1, q + 1)]
    left = lag(z, 0)
    if x:
        left = left - np.column_stack(x) @ np.linalg.lstsq(np.column_stack(x), left, rcond=None)[0]
    return n, (left @ left) / n


def test_every_order_against_regressions(spark):
    data = simulated()
    parts = timeseries.split(series(spark, **data), 10)
    rows = forecast.arima_search(parts).collect()
    assert len(rows) == 3 * 18
    for r in rows:
        n, want = variance_by_regression(np.array(data[r["series"]][:-10]), r["p"], r["d"], r["q"], 2, 1)
        assert r["n"] == n and r["sigma2"] == pytest.approx(want, rel=1e-8)
        assert r["bic"] == pytest.approx(n * np.log(want) + (r["p"] + r["q"] + (r["d"] == 0)) * np.log(n), rel=1e-8)
    best = {r["series"]: (r["p"], r["d"], r["q"]) for r in rows if r["chosen"]}
    assert best == {"ar": (2, 0, 0), "ima": (0, 1, 1), "white": (0, 0, 0)}


def test_best_order_forecasts(spark):
    data = simulated() | {"line": 3.0 * np.arange(60), "flat": np.full(40, 7.0), "short": np.arange(12.0)}
    parts = timeseries.split(series(spark, **data), 5)
    got = {}
    for r in forecast.best_arima(parts).orderBy("series", "period").collect():
        got.setdefault(r["series"], []).append((r["y"], r["yhat"]))
    assert all(yhat is None for _, yhat in got["short"]) and len(got["short"]) == 5
    assert all(abs(y - yhat) < 1e-6 for y, yhat in got["line"] + got["flat"])
    # After one step the forecast of an IMA(1, 1) stays; that of white noise is the mean.
    assert len({round(yhat, 6) for _, yhat in got["ima"]}) == 1
    assert got["white"][0][1] == pytest.approx(data["white"][:-5].mean())
    chosen = {r["series"] for r in forecast.arima_search(parts).where("chosen").collect()}
    assert chosen == set(data) - {"short"}


def test_pure_season_is_exact(spark):
    season = [10, 20, 30, 40, 30, 20, 10, 5, 0, 5, 10, 15]
    data = {"pure": season * 6, "rising": [v + i // 12 * 3 for i, v in enumerate(season * 6)], "short": season}
    parts = timeseries.split(series(spark, **data), 12)
    for order, seasonal in (((1, 0, 0), (1, 1, 0, 12)), ((0, 0, 0), (0, 1, 0, 12)), ((1, 1, 1), (1, 1, 1, 12))):
        rows = forecast.arima(parts, order, seasonal).collect()
        error = {}
        for r in rows:
            error.setdefault(r["series"], []).append(None if r["yhat"] is None else abs(r["y"] - r["yhat"]))
        assert max(error["pure"]) < 1e-6 and error["short"] == [None] * 12
        if order == (1, 1, 1):
            assert max(error["rising"]) < 1e-6
    reported = timeseries.with_errors(metrics.forecast_metrics(forecast.arima(parts, (1, 0, 0), (1, 1, 0, 12)))).collect()
    assert {r["series"]: r["error"] is not None for r in reported} == {"pure": False, "rising": False, "short": True}


def test_seasonal_polynomials_multiply():
    draw = np.random.default_rng(8)
    e, z = draw.standard_normal(4000), np.zeros(4000)
    for t in range(13, 4000):  # (1 - 0.5 B)(1 - 0.6 B^12) z = e
        z[t] = 0.5 * z[t - 1] + 0.6 * z[t - 12] - 0.3 * z[t - 13] + e[t]
    ahead = forecast.seasonal_fit(z + 20, (1, 0, 0), (1, 0, 0, 12), 1)[0]
    mean = (z + 20).mean()
    y = z + 20 - mean
    assert ahead == pytest.approx(mean + 0.5 * y[-1] + 0.6 * y[-12] - 0.3 * y[-13], abs=0.15)
    ma = e.copy()
    ma[1:] += 0.5 * e[:-1]
    both = ma.copy()
    both[12:] += 0.4 * ma[:-12]  # (1 + 0.5 B)(1 + 0.4 B^12) e
    ahead = forecast.seasonal_fit(both, (0, 0, 1), (0, 0, 1, 12), 1)[0]
    assert ahead == pytest.approx(0.5 * e[-1] + 0.4 * e[-12] + 0.2 * e[-13], abs=0.3)
    with pytest.raises(ValueError):
        forecast.seasonal_fit(z, (1, 0, 0), (1, 0, 0, 1), 1)


def test_kinks_come_back(spark):
    draw = np.random.default_rng(3)
    day = np.arange(1500.0)
    hinge = np.maximum(day - 600, 0)
    season = 20 * np.sin(2 * np.pi * day / 365.25)
    data = {
        "kinked": 100 + 0.10 * day - 0.35 * hinge + season + draw.standard_normal(1500),
        "two": 0.2 * day - 0.4 * np.maximum(day - 300, 0) + 0.5 * np.maximum(day - 900, 0) + draw.standard_normal(1500),
        "straight": 5 + 0.05 * day + season + draw.standard_normal(1500),
    }
    parts = timeseries.split(series(spark, **data), 100)
    rows = forecast.trend_breaks(parts, weekly_seasonality=False).collect()
    origin = datetime.date(2018, 1, 1)
    slope_at = lambda name, t: [r["slope"] for r in sorted(rows, key=lambda r: r["day"]) if r["series"] == name and (r["day"] - origin).days <= t][-1]
    for name, t, slope in (("kinked", 500, 0.1), ("kinked", 700, -0.25), ("two", 200, 0.2), ("two", 700, -0.2), ("two", 1100, 0.3)):
        assert slope_at(name, t) == pytest.approx(slope * 365.25, rel=0.06), (name, t)
    near = [(r["day"] - origin).days for r in rows if r["series"] == "kinked" and abs(r["change"]) > 10]
    assert near and all(500 <= t <= 700 for t in near)
    assert sum(abs(r["change"]) for r in rows if r["series"] == "straight") < 4
    error = {r["series"]: r["mae"] for r in metrics.forecast_metrics(forecast.fourier(parts, weekly_seasonality=False)).collect()}
    straight = {r["series"]: r["mae"] for r in metrics.forecast_metrics(forecast.fourier(parts, weekly_seasonality=False, breaks=0)).collect()}
    assert error["kinked"] < 5 and error["kinked"] < straight["kinked"] / 10 and error["straight"] < 3


def test_sparse_weights_meet_their_conditions():
    draw = np.random.default_rng(4)
    for _ in range(100):
        x = draw.standard_normal((60, 8)) @ np.triu(np.ones((8, 8)))
        gram, moment, threshold = x.T @ x, x.T @ draw.standard_normal(60), draw.random(8) * 10
        w = forecast.sparse_weights(gram, moment, threshold)
        left = moment - gram @ w
        assert (abs(left) <= threshold + 1e-6).all()
        assert abs(left - threshold * np.sign(w))[w != 0].max(initial=0) < 1e-6


def test_given_breaks_are_kept(spark):
    day = np.arange(400.0)
    data = {"s": 3 + 0.5 * day - 0.8 * np.maximum(day - 200, 0), "untrained": [1.0, 2.0]}
    parts = timeseries.split(series(spark, **data), 10)
    given = [str(datetime.date(2018, 1, 1) + datetime.timedelta(days=200))]
    rows = forecast.trend_breaks(parts, False, False, 1e-9, given).orderBy("day").collect()
    assert [round(r["slope"] / 365.25, 6) for r in rows] == [0.5, -0.3] and str(rows[1]["day"]) == given[0]
    table = forecast.fourier(parts, False, False, 1e-9, given).collect()
    assert all(abs(r["y"] - r["yhat"]) < 1e-4 for r in table if r["series"] == "s")
