"""Forecasting models over many series at once."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.linear import entry, gram, swept, transformed
from shelfwise.operators.timeseries import test_part, train_part

# Smoothing parameters tried by the search: alpha, beta, gamma, phi.
GRID = list(product((0.1, 0.3, 0.5, 0.8), (0.05, 0.2, 0.5), (0.05, 0.2, 0.5), (0.8, 0.9, 0.98)))

_FORECAST = "series string, period date, model string, y double, yhat double"


def _history(parts: DataFrame) -> DataFrame:
    """(series, ys): training values in order, one array per series."""
    pairs = F.array_sort(F.collect_list(F.struct("period", "value")))
    return train_part(parts).groupBy("series").agg(pairs.alias("_p")).select("series", F.col("_p.value").alias("ys"))


def _numbered_test(parts: DataFrame) -> DataFrame:
    """(series, period, y, h): test periods with their step 1, 2, ..."""
    pairs = F.array_sort(F.collect_list(F.struct("period", "value")))
    return test_part(parts).groupBy("series").agg(pairs.alias("_p")).select(
        "series", F.posexplode("_p").alias("_i", "_v")
    ).select("series", F.col("_v.period").alias("period"), F.col("_v.value").alias("y"), (F.col("_i") + 1).alias("h"))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)


def _smoothed(seasonal: str, periods: int) -> Column:
    """Final (level, trend, seasons, sse) of the damped-trend recursion over array ``ys``.

    It starts on the line through the mean of the first season whose slope is the mean change to
    the second, with the first season's deviations from that line.
    """
    m = periods
    alpha, beta, gamma, phi = (F.col(c) for c in ("alpha", "beta", "gamma", "phi"))
    first = F.slice("ys", 1, m)
    middle = _mean(first)
    trend0 = (_mean(F.slice("ys", m + 1, m)) - middle) / m
    line = lambda i: middle + trend0 * (i - (m - 1) / 2)
    if seasonal == "add":
        apart, join = (lambda y, s: y - s), (lambda x, s: x + s)
    elif seasonal == "mul":
        apart, join = F.try_divide, (lambda x, s: x * s)
    else:
        raise ValueError("seasonal must be 'add' or 'mul'")

    def step(state, y):
        season = F.element_at(state["seasons"], 1)
        ahead = state["level"] + phi * state["trend"]
        level = alpha * apart(y, season) + (1 - alpha) * ahead
        trend = beta * (level - state["level"]) + (1 - beta) * phi * state["trend"]
        renewed = gamma * apart(y, ahead) + (1 - gamma) * season
        error = y - join(ahead, season)
        return F.struct(
            level.alias("level"), trend.alias("trend"),
            F.concat(F.slice(state["seasons"], 2, m - 1), F.array(renewed)).alias("seasons"),
            (state["sse"] + error * error).alias("sse"),
        )

    start = F.struct(
        line(F.lit(-1)).alias("level"), trend0.alias("trend"),
        F.transform(first, lambda y, i: apart(y, line(i))).alias("seasons"), F.lit(0.0).alias("sse"))
    return F.aggregate("ys", start, step)


def holt_winters(
    parts: DataFrame,
    seasonal: str = "add",
    seasonal_periods: int = 12,
    grid: Sequence[tuple[float, float, float, float]] = GRID,
) -> DataFrame:
    """Damped additive trend with additive or multiplicative season, per series.

    Every (alpha, beta, gamma, phi) of the grid is run and the one with the least squared
    one-step error is kept. A series needs two full seasons; the test rows of shorter ones have a null
    ``yhat``, which ``timeseries.with_errors`` reports.
    """
    m = seasonal_periods
    names = ("alpha", "beta", "gamma", "phi")
    options = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, p)]) for p in grid])
    tried = _history(parts).where(F.size("ys") >= 2 * m).select("series", "ys", F.inline(options))
    fitted = tried.select("series", "phi", *names[:3], _smoothed(seasonal, m).alias("s"))
    best = fitted.groupBy("series").agg(
        F.min_by(F.struct("s", "phi"), F.struct(F.col("s.sse"), *[F.col(n) for n in names])).alias("b")
    ).select("series", "b.s.*", "b.phi")
    h, phi = F.col("h"), F.col("phi")
    damping = F.when(phi == 1, h.cast("double")).otherwise(phi * (1 - F.pow(phi, h)) / (1 - phi))
    base = F.col("level") + damping * F.col("trend")
    season = F.element_at("seasons", F.pmod(h - 1, F.lit(m)).cast("int") + 1)
    return _numbered_test(parts).join(best, "series", "left").select(
        "series", "period", F.lit("HoltWinters").alias("model"), "y",
        (base + season if seasonal == "add" else base * season).alias("yhat"),
    )


# Orders tried by the search.
ORDERS = {"p": (0, 1, 2), "d": (0, 1), "q": (0, 1, 2)}


def _lag_moments(parts: DataFrame, ds: Sequence[int], lags: int) -> DataFrame:
    """(series, d, n, g, z, levels, mean): one Gram matrix ``g`` of z(t) .. z(t - lags) for each series and order of differences.

    z are the differenced values, or the values less their mean where d = 0. All d share the same n periods.
    ``z`` and ``levels``, at the last period, hold what a forecast starts from.
    """
    window = Window.partitionBy("series").orderBy("period")
    rows = train_part(parts).withColumns({
        "_0": F.col("value"), "_t": F.row_number().over(window), "_mean": F.avg("value").over(Window.partitionBy("series"))})
    for d in range(1, max(ds) + 1):
        rows = rows.withColumn(f"_{d}", F.col(f"_{d - 1}") - F.lag(f"_{d - 1}").over(window))
    centred = {d: F.col("_0") - F.col("_mean") if d == 0 else F.col(f"_{d}") for d in ds}
    rows = rows.withColumns({f"_z{d}": z for d, z in centred.items()})
    stacked = rows.withColumns({f"_lags{d}": F.array(*[F.lag(f"_z{d}", k).over(window) for k in range(lags + 1)]) for d in ds})
    each = F.array(*[F.struct(
        F.lit(d).alias("d"), F.col(f"_lags{d}").alias("z"), F.array(*[F.col(f"_{k}") for k in range(d)]).cast("array<double>").alias("levels"),
        (F.col("_mean") if d == 0 else F.lit(0.0)).alias("mean")) for d in ds])
    lagged = stacked.where(F.col("_t") > lags + max(ds)).select("series", "period", F.inline(each))
    last = F.max_by(F.struct("z", "levels", "mean"), "period").alias("_last")
    moments = gram([f"z[{k}]" for k in range(lags + 1)]).alias("g")
    return lagged.groupBy("series", "d").agg(F.count("*").alias("n"), moments, last).select("series", "d", "n", "g", "_last.*")


def arima_models(parts: DataFrame, p: Sequence[int], d: Sequence[int], q: Sequence[int]) -> DataFrame:
    """(series, p, d, q, n, sigma2, bic, ...): every order fitted to every series from one matrix of lag moments.

    Hannan-Rissanen: a long autoregression, of max(p, q) + 4 lags, gives the shocks; as they are combinations of lags,
    their moments follow from those of the lags, and each order is a regression on some lags and lagged shocks.
    ``bic`` is n ln(sigma2) + k ln(n) with k coefficients, the mean of undifferenced values being one;
    all orders predict the same n periods. Series with fewer periods than the long autoregression has lags have no row.
    """
    top_p, top_q = max(p), max(q)
    long = max(top_p, top_q) + 4
    lags = long + top_q
    size, m = lags + 1, 1 + top_p + top_q
    moments = _lag_moments(parts, sorted(set(d)), lags).where(F.col("n") >= long)
    auto = swept(F.col("g"), size, F.array(*[F.lit(k) for k in range(1, long + 1)]))
    fitted = moments.withColumn("_auto", auto).withColumn("phi", F.array(*[entry(F.col("_auto"), size, k, 0) for k in range(1, long + 1)]))
    lag = [{i: "1"} for i in range(top_p + 1)]
    shock = [{j: "1"} | {j + k: f"-phi[{k - 1}]" for k in range(1, long + 1)} for j in range(1, top_q + 1)]
    small = transformed("g", size, lag + shock)
    orders = F.array(*[F.struct(
        F.lit(i).alias("p"), F.lit(j).alias("q"),
        F.array(*[F.lit(k) for k in [*range(1, i + 1), *range(top_p + 1, top_p + 1 + j)]]).cast("array<int>").alias("_pivots"))
        for i in p for j in q])
    tried = fitted.withColumn("_small", small).select("*", F.inline(orders)).withColumn("_fit", swept(F.col("_small"), m, F.col("_pivots")))
    # An exact fit leaves rounding errors only, which must not decide between orders.
    sigma2 = F.greatest(entry(F.col("_fit"), m, 0, 0), 1e-12 * F.col("g")[0]) / F.col("n")
    weight = lambda k, used: F.when(used, entry(F.col("_fit"), m, k, 0)).otherwise(0.0)
    k = F.col("p") + F.col("q") + (F.col("d") == 0).cast("int")
    return tried.select(
        "series", "p", "d", "q", "n", sigma2.alias("sigma2"), "phi", "z", "levels", "mean",
        F.array(*[weight(i, F.col("p") >= i) for i in range(1, top_p + 1)]).cast("array<double>").alias("ar"),
        F.array(*[weight(top_p + j, F.col("q") >= j) for j in range(1, top_q + 1)]).cast("array<double>").alias("ma"),
    ).withColumn("bic", F.col("n") * F.ln(F.greatest("sigma2", F.lit(1e-300))) + k * F.ln(F.col("n").cast("double")))


def chosen(models: DataFrame) -> DataFrame:
    """The model with the smallest ``bic`` of each series; among equal ones that with fewer differences, then lags, then shocks."""
    rest = [c for c in models.columns if c != "series"]
    best = F.min_by(F.struct(*rest), F.struct("bic", "d", "p", "q"))
    return models.groupBy("series").agg(best.alias("_best")).select("series", "_best.*")


def arima_search(parts: DataFrame, p: Sequence[int] = ORDERS["p"], d: Sequence[int] = ORDERS["d"], q: Sequence[int] = ORDERS["q"]) -> DataFrame:
    """(series, p, d, q, n, sigma2, bic, chosen): all orders of the grid for each series, the best one marked."""
    models = arima_models(parts, p, d, q).select("series", "p", "d", "q", "n", "sigma2", "bic")
    first = F.row_number().over(Window.partitionBy("series").orderBy("bic", "d", "p", "q"))
    return models.withColumn("chosen", first == 1)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _paths(models: DataFrame, steps: DataFrame) -> DataFrame:
    """(series, path): the recursive forecast of each model over as many periods as ``steps`` (series, steps) says."""
    none = F.array().cast("array<double>")
    long = F.size("phi")
    shocks = F.transform("ma", lambda _, j: F.element_at("z", j + 1) - _dot(F.slice("z", j + 2, long), F.col("phi")))

    def step(state, _):
        new = _dot(F.col("ar"), state["zs"]) + _dot(F.col("ma"), state["es"])
        push = lambda value, old: F.when(F.size(old) > 0, F.concat(F.array(value), F.slice(old, F.lit(1), F.size(old) - 1))).otherwise(old)
        return F.struct(push(new, state["zs"]).alias("zs"), push(F.lit(0.0), state["es"]).alias("es"),
                        F.concat(state["path"], F.array(new)).alias("path"))

    def summed(path, last):
        start = F.struct(last.alias("at"), none.alias("path"))
        grow = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["path"], F.array(s["at"] + x)).alias("path"))
        return F.aggregate(path, start, grow, lambda s: s["path"])

    ready = models.join(steps, "series").withColumn("_shocks", shocks)
    start = F.struct(F.slice("z", F.lit(1), F.size("ar")).alias("zs"), F.col("_shocks").alias("es"), none.alias("path"))
    differenced = ready.withColumn("_path", F.aggregate(F.sequence(F.lit(1), F.col("steps")), start, step, lambda s: s["path"]))
    whole = F.aggregate(F.reverse("levels"), F.transform("_path", lambda x: x + F.col("mean")), summed)
    return differenced.select("series", whole.alias("path"))


def arima_forecast(parts: DataFrame, models: DataFrame) -> DataFrame:
    """(series, period, model, y, yhat) from one model for each series; a series without one has a null ``yhat``."""
    test = _numbered_test(parts)
    steps = test.groupBy("series").agg(F.max("h").alias("steps"))
    return test.join(_paths(models, steps), "series", "left").select(
        "series", "period", F.lit("ARIMA").alias("model"), "y", F.element_at("path", F.col("h")).alias("yhat"))


def arima(parts: DataFrame, order: tuple[int, int, int] = (1, 1, 1), seasonal_order: tuple[int, int, int, int] | None = None) -> DataFrame:
    """ARIMA(p, d, q) per series, estimated by regression; see ``arima_models`` and, with a season, ``seasonal_fit``.

    A series too short for the fit has a null ``yhat``, which ``timeseries.with_errors`` reports.
    """
    if seasonal_order is None:
        p, d, q = order
        return arima_forecast(parts, arima_models(parts, [p], [d], [q]))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        test = pdf[pdf["part"] == "test"]
        train = pdf.loc[pdf["part"] == "train", "value"].to_numpy(dtype=float)
        fitted = seasonal_fit(train, order, seasonal_order, len(test))
        yhat = np.full(len(test), np.nan) if fitted is None else fitted
        return pd.DataFrame({
            "series": test["series"], "period": test["period"], "model": "SARIMA", "y": test["value"], "yhat": yhat})

    made = parts.groupBy("series").applyInPandas(run, _FORECAST)
    return made.withColumn("yhat", F.when(~F.isnan("yhat"), F.col("yhat")))


def best_arima(parts: DataFrame, p: Sequence[int] = ORDERS["p"], d: Sequence[int] = ORDERS["d"], q: Sequence[int] = ORDERS["q"]) -> DataFrame:
    """The forecast of each series by the order that ``arima_search`` marks."""
    return arima_forecast(parts, chosen(arima_models(parts, p, d, q)))


def _filtered(values: np.ndarray, weights: np.ndarray, season: int) -> np.ndarray:
    """values(t) + sum of weights(k) * values(t - k * season); values before the first count as 0."""
    out = values.copy()
    for k, w in enumerate(weights, 1):
        out[k * season :] += w * values[: len(values) - k * season]
    return out


def _behind(values: np.ndarray, lags: Sequence[int], start: int) -> np.ndarray:
    return np.column_stack([values[start - k : len(values) - k] for k in lags]) if len(lags) else np.empty((len(values) - start, 0))


def seasonal_fit(
    ys: np.ndarray, order: tuple[int, int, int], seasonal_order: tuple[int, int, int, int], steps: int, rounds: int = 50
) -> np.ndarray | None:
    """Forecast of ARIMA(p, d, q)(P, D, Q)s, whose polynomials are the products of a short and a seasonal one.

    A long autoregression on recent and seasonal lags gives the shocks. With the seasonal polynomials held the
    short ones are a linear regression on filtered values and shocks, and the other way round; the two take turns until
    they stay. None for series with fewer values than the regressions have coefficients.
    """
    (p, d, q), (sp, sd, sq, s) = order, seasonal_order
    if s < 2:
        raise ValueError("the season must have two periods at least")
    z, undo = np.asarray(ys, dtype=float), []
    for lag in [s] * sd + [1] * d:
        if len(z) <= lag:
            return None
        undo.append((z[-lag:], lag))
        z = z[lag:] - z[:-lag]
    mean = z.mean() if len(z) and d + sd == 0 else 0.0
    z = z - mean
    recent = max(p, q) + 2
    lags = sorted({*range(1, recent + 1), *(k * s + j for k in range(1, max(sp, sq) + 1) for j in range(recent + 1))})
    start = lags[-1] + max(p + sp * s, q + sq * s)
    if len(z) - start < max(len(lags), p + q + sp + sq + 1):
        return None
    solve = lambda x, y: np.linalg.lstsq(x, y, rcond=None)[0]
    x = _behind(z, lags, lags[-1])
    shocks = np.zeros(len(z))
    shocks[lags[-1] :] = z[lags[-1] :] - x @ solve(x, z[lags[-1] :])
    ar, ma, sar, sma = np.zeros(p), np.zeros(q), np.zeros(sp), np.zeros(sq)
    for _ in range(rounds if p + q + sp + sq else 0):
        before = np.concatenate([ar, ma, sar, sma])
        zs, es = _filtered(z, -sar, s), _filtered(shocks, sma, s)
        known = (zs - (es - shocks))[start:]
        found = solve(np.hstack([_behind(zs, range(1, p + 1), start), _behind(es, range(1, q + 1), start)]), known)
        ar, ma = found[:p], found[p:]
        zs, es = _filtered(z, -ar, 1), _filtered(shocks, ma, 1)
        known = (zs - (es - shocks))[start:]
        found = solve(np.hstack([
            _behind(zs, range(s, sp * s + 1, s), start), _behind(es, range(s, sq * s + 1, s), start)]), known)
        sar, sma = found[:sp], found[sp:]
        if np.abs(np.concatenate([ar, ma, sar, sma]) - before).max() < 1e-10:
            break
    spread = lambda weights: np.concatenate([[1.0], np.kron(weights, np.eye(1, s, s - 1)[0])])
    a = -np.convolve(np.concatenate([[1.0], -ar]), spread(-sar))[1:]
    b = np.convolve(np.concatenate([[1.0], ma]), spread(sma))[1:]
    zs, es = list(z), list(shocks)
    for _ in range(steps):
        zs.append(sum(w * zs[-k] for k, w in enumerate(a, 1)) + sum(w * es[-k] for k, w in enumerate(b, 1)))
        es.append(0.0)
    out = np.array(zs[len(z) :]) + mean
    for last, lag in reversed(undo):
        whole = np.concatenate([last, out])
        for i in range(lag, len(whole)):
            whole[i] += whole[i - lag]
        out = whole[lag:]
    return out


BREAKS = 25  # candidate breaks of the trend, over the first BREAK_SPAN of the training periods
BREAK_SPAN = 0.8


def fourier_design(days: np.ndarray, origin: float, yearly: bool, weekly: bool, knots: Sequence[float] = ()) -> np.ndarray:
    """Intercept, trend in years, sine/cosine pairs (10 yearly and 3 weekly), and years since each knot, 0 before it."""
    columns = [np.ones_like(days), (days - origin) / 365.25]
    for active, period, pairs in ((yearly, 365.25, 10), (weekly, 7.0, 3)):
        for k in range(1, pairs + 1) if active else ():
            angle = 2 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns + [np.maximum(days - knot, 0) / 365.25 for knot in knots])


def sparse_weights(gram: np.ndarray, moment: np.ndarray, threshold: np.ndarray, cycles: int = 2000) -> np.ndarray:
    """Minimum of b'Gb / 2 - b'm + sum of threshold * |b|, by coordinate descent with soft thresholds.

    As soon as the signs found solve their penalised normal equations, with no other coordinate beyond its threshold,
    that exact solution is returned.
    """
    weights, scale = np.zeros(len(moment)), np.diag(gram)
    for cycle in range(cycles):
        before = weights.copy()
        for j in np.flatnonzero(scale > 0):
            pull = moment[j] - gram[j] @ weights + scale[j] * weights[j]
            weights[j] = np.sign(pull) * max(abs(pull) - threshold[j], 0.0) / scale[j]
        support = np.flatnonzero(weights)
        if cycle % 10 == 9 or not len(support):
            sign, exact = np.sign(weights[support]), np.zeros(len(moment))
            exact[support] = np.linalg.lstsq(gram[np.ix_(support, support)], moment[support] - threshold[support] * sign, rcond=None)[0]
            left = np.abs(moment - gram @ exact)
            left[support] = 0
            if (np.sign(exact[support]) == sign).all() and (left <= threshold * (1 + 1e-9)).all():
                return exact
        if np.abs(weights - before).max(initial=0.0) <= 1e-14 * np.abs(weights).max(initial=0.0):
            break
    return weights


def fit_trend(x: np.ndarray, y: np.ndarray, hinges: int, ridge: float, strictness: float | None) -> np.ndarray:
    """Weights of a design whose last ``hinges`` columns are breaks of the trend.

    All but the intercept pay ``ridge`` times their square. With ``strictness`` breaks also pay in proportion to their size,
    each as much as noise would earn it: strictness * sigma * sqrt(2 ln hinges) standard errors, with sigma from
    the fit with all breaks. Everything is read from the series' Gram matrix.
    """
    gram, moment = x.T @ x + np.diag([0.0] + [ridge] * (x.shape[1] - 1)), x.T @ y
    solve = lambda a, b: np.linalg.lstsq(a, b, rcond=None)[0]
    if not hinges or strictness is None:
        return solve(gram, moment)
    free = x.shape[1] - hinges
    crossed = solve(gram[:free, :free], gram[:free, free:])
    # What is left of the breaks once the other columns have explained what they can.
    reduced, pull = gram[free:, free:] - gram[free:, :free] @ crossed, moment[free:] - crossed.T @ moment[:free]
    left = y - x @ solve(gram, moment)
    sigma = (left @ left / max(len(y) - x.shape[1], 1)) ** 0.5
    least = strictness * sigma * max(2 * np.log(hinges), 1.0) ** 0.5
    breaks = sparse_weights(reduced, pull, least * np.sqrt(np.maximum(np.diag(reduced), 0)))
    return np.concatenate([solve(gram[:free, :free], moment[:free] - gram[:free, free:] @ breaks), breaks])


def _day_numbers(dates) -> np.ndarray:
    return (pd.to_datetime(pd.Series(dates)) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(dtype=float)


def _trend_fit(pdf: pd.DataFrame, yearly: bool, weekly: bool, ridge: float, breaks, strictness: float):
    """(days, knots, weights, design) of one series in order of time; weights are None without training periods."""
    days, train = _day_numbers(pdf["period"]), (pdf["part"] == "train").to_numpy()
    if isinstance(breaks, int):
        early = days[train][: max(int(train.sum() * BREAK_SPAN), 0)]
        knots = np.unique(np.quantile(early, np.linspace(0, 1, breaks + 1)[1:])) if len(early) and breaks else np.empty(0)
    else:
        knots, strictness = _day_numbers(breaks), None  # given breaks stay
    x = fourier_design(days, days[0], yearly, weekly, knots)
    if not train.any():
        return days, knots, None, x
    y = pdf["value"].to_numpy(dtype=float)[train]
    return days, knots, fit_trend(x[train], y, len(knots), ridge, strictness), x


def fourier(
    parts: DataFrame, yearly_seasonality: bool = True, weekly_seasonality: bool = True, ridge: float = 0.01,
    breaks: int | Sequence[str] = BREAKS, strictness: float = 1.0,
) -> DataFrame:
    """Trend with breaks plus yearly and weekly Fourier terms per series, by penalised regression.

    ``breaks`` is the number of candidates, at even shares of the first periods, of which the fit keeps what the series
    calls for, or the dates of breaks that are known; 0 gives a straight trend. See ``fit_trend``.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        _, _, weights, x = _trend_fit(pdf, yearly_seasonality, weekly_seasonality, ridge, breaks, strictness)
        ahead = (pdf["part"] != "train").to_numpy()
        test = pdf[ahead]
        yhat = np.full(len(test), np.nan) if weights is None else x[ahead] @ weights
        return pd.DataFrame({
            "series": test["series"], "period": test["period"], "model": "Fourier", "y": test["value"], "yhat": yhat})

    return parts.groupBy("series").applyInPandas(run, _FORECAST)


def trend_breaks(
    parts: DataFrame, yearly_seasonality: bool = True, weekly_seasonality: bool = True, ridge: float = 0.01,
    breaks: int | Sequence[str] = BREAKS, strictness: float = 1.0,
) -> DataFrame:
    """(series, day, slope, change): the slope a year of the trend that ``fourier`` fits, from its first day and from each break on."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        days, knots, weights, x = _trend_fit(pdf, yearly_seasonality, weekly_seasonality, ridge, breaks, strictness)
        if weights is None:
            return pd.DataFrame({c: pd.Series(dtype=kind) for c, kind in
                                 (("series", object), ("day", object), ("slope", float), ("change", float))})
        change = weights[x.shape[1] - len(knots) :]
        kept = np.flatnonzero(change)
        day = pd.Timestamp("1970-01-01") + pd.to_timedelta(np.concatenate([days[:1], np.floor(knots[kept])]), unit="D")
        return pd.DataFrame({
            "series": pdf["series"].iloc[0], "day": pd.Series(day).dt.date,
            "slope": weights[1] + np.concatenate([[0.0], np.cumsum(change[kept])]),
            "change": np.concatenate([[0.0], change[kept]])})

    return parts.groupBy("series").applyInPandas(run, "series string, day date, slope double, change double")
