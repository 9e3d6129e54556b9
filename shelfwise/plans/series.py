"""Time-series and forecasting queries."""

from pyspark.sql import functions as F

from shelfwise.operators import forecast, timeseries
from shelfwise.operators.metrics import forecast_metrics
from shelfwise.plans.common import rounded
from shelfwise.plans.registry import SALES, query
from shelfwise.sources.tables import sales_lines

_PERIOD = {
    "D": ("CAST({d} AS DATE)", "INTERVAL 1 DAY"),
    "W": ("CAST(date_trunc('week', {d}) AS DATE) + 6", "INTERVAL 7 DAY"),
    "M": ("last_day(CAST({d} AS DATE))", None),
}


def series_sql(freq, series=None, value="sum(sales)", drop_zero_runs=False):
    """CTE ``ts`` (series, period, value) over the CTE ``sales``."""
    label, step = _PERIOD[freq]
    name = f"CAST({series} AS VARCHAR)" if series else "'all'"
    if step:
        grid = f"SELECT series, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, {step})) AS DATE) AS period FROM span"
    else:
        grid = ("SELECT series, last_day(CAST(unnest(generate_series(date_trunc('month', lo)::TIMESTAMP, "
                "date_trunc('month', hi)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE)) AS period FROM span")
    full = f"""valued AS (SELECT {name} AS series, {label.format(d='order_date')} AS period, {value} AS v FROM sales GROUP BY 1, 2),
span AS (SELECT series, min(period) AS lo, max(period) AS hi FROM valued GROUP BY series), grid AS ({grid}),
filled AS (SELECT series, period, coalesce(v, 0) AS value FROM grid LEFT JOIN valued USING (series, period))"""
    if not drop_zero_runs:
        return full + ", ts AS (SELECT * FROM filled)"
    return full + """, ts AS (SELECT series, period, value FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY period) AS b FROM filled)
  WHERE value <> 0 OR b IS NULL OR b <> 0)"""


def split_sql(n_test):
    return f"""parts AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY period DESC) <= {n_test}
  THEN 'test' ELSE 'train' END AS part FROM ts)"""


def prepared(spark, sf_dir, freq, series_col=None, value="sales", agg="sum"):
    columns = ["order_date", value, *([series_col] if series_col else [])]
    return timeseries.prepare_time_series(
        sales_lines(spark, sf_dir, columns), "order_date", value, agg, freq=freq, series_col=series_col)


def _prepare_query(name, freq):
    @query(f"ts_prepare_{name}", f"WITH {SALES}, {series_sql(freq, drop_zero_runs=True)} SELECT series, period, round(value, 2) AS value FROM ts")
    def run(spark, sf_dir):
        return rounded(prepared(spark, sf_dir, freq), 2)


_prepare_query("daily", "D")
_prepare_query("weekly", "W")
_prepare_query("monthly", "M")


@query("ts_prepare_per_customer", f"""WITH {SALES}, {series_sql('M', 'customer_id', drop_zero_runs=True)}
SELECT series, period, round(value, 4) AS value FROM ts""")
def ts_prepare_per_customer(spark, sf_dir):
    return rounded(prepared(spark, sf_dir, "M", "customer_id"))


@query("ts_prepare_median", f"""WITH {SALES}, {series_sql('M', 'category', 'median(quantity)', drop_zero_runs=True)}
SELECT series, period, value FROM ts""")
def ts_prepare_median(spark, sf_dir):
    return prepared(spark, sf_dir, "M", "category", "quantity", "median")


@query("eda_resample", f"""WITH {SALES}, {series_sql('W', 'customer_id')}
SELECT series, period, round(value, 4) AS value FROM ts""")
def eda_resample(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, ["order_date", "sales", "customer_id"])
    return rounded(timeseries.resample(lines, "order_date", "sales", "W", series_col="customer_id"))


@query("ts_split", f"""WITH {SALES}, {series_sql('W', 'category', drop_zero_runs=True)},
{split_sql('floor(0.2 * count(*) OVER (PARTITION BY series))')} SELECT series, period, round(value, 2) AS value, part FROM parts""")
def ts_split(spark, sf_dir):
    return rounded(timeseries.split(prepared(spark, sf_dir, "W", "category")), 2)


# Weekly sales per category, the last 12 weeks held out.
_WEEKLY = f"WITH {SALES}, {series_sql('W', 'category', drop_zero_runs=True)}, {split_sql(12)}"
_NAIVE = "naive AS (SELECT series, max_by(value, period) AS yhat FROM parts WHERE part = 'train' GROUP BY series)"
_MEAN4 = """mean4 AS (SELECT series, avg(value) AS yhat FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS k
  FROM parts WHERE part = 'train') WHERE k <= 4 GROUP BY series)"""
_BOTH = f"""{_NAIVE}, {_MEAN4}, fc AS (
  SELECT p.series, period, 'Naive' AS model, value AS y, yhat FROM parts p JOIN naive n ON n.series = p.series WHERE part = 'test'
  UNION ALL SELECT p.series, period, 'MA_4', value, yhat FROM parts p JOIN mean4 m ON m.series = p.series WHERE part = 'test')"""


def weekly_parts(spark, sf_dir):
    return timeseries.split(prepared(spark, sf_dir, "W", "category"), 12)


def _both(parts):
    return timeseries.naive(parts).unionByName(timeseries.moving_average(parts, 4))


@query("ts_naive", f"{_WEEKLY}, {_BOTH} SELECT series, period, model, round(y, 2) AS y, round(yhat, 2) AS yhat FROM fc WHERE model = 'Naive'")
def ts_naive(spark, sf_dir):
    return rounded(timeseries.naive(weekly_parts(spark, sf_dir)), 2)


@query("ts_moving_average", f"{_WEEKLY}, {_BOTH} SELECT series, period, model, round(y, 2) AS y, round(yhat, 2) AS yhat FROM fc WHERE model = 'MA_4'")
def ts_moving_average(spark, sf_dir):
    return rounded(timeseries.moving_average(weekly_parts(spark, sf_dir), 4), 2)


@query("ts_compare", f"""{_WEEKLY}, {_BOTH} SELECT series, model, round(avg(abs(y - yhat)), 2) AS mae,
  round(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse,
  round(avg(2 * abs(yhat - y) / (abs(y) + abs(yhat) + 1e-8)) * 100, 4) AS smape,
  round(avg(abs((y - yhat) / (y + 1e-8))) * 100, 4) AS mape FROM fc GROUP BY series, model""")
def ts_compare(spark, sf_dir):
    table = timeseries.compare_forecasts(_both(weekly_parts(spark, sf_dir)))
    return rounded(rounded(table, 4, ["smape", "mape"]), 2, ["mae", "rmse"])


@query("ts_residuals", f"""{_WEEKLY}, {_BOTH} SELECT series, model, round(avg(y - yhat), 2) AS mean, round(stddev_pop(y - yhat), 2) AS std,
  round(min(y - yhat), 2) AS min, round(max(y - yhat), 2) AS max FROM fc GROUP BY series, model""")
def ts_residuals(spark, sf_dir):
    return rounded(timeseries.residual_stats(_both(weekly_parts(spark, sf_dir))), 2)


_LAGS = " UNION ALL ".join(
    f"""SELECT series, model, {k} AS lag, sum(d * dk) / any_value(s) AS acf FROM (
  SELECT series, model, d, lag(d, {k}) OVER (PARTITION BY series, model ORDER BY period) AS dk, sum(d * d) OVER (PARTITION BY series, model) AS s
  FROM dev) GROUP BY series, model""" for k in range(11))


@query("ts_acf", f"""WITH RECURSIVE {SALES}, {series_sql('W', 'category', drop_zero_runs=True)}, {split_sql(12)}, {_BOTH},
dev AS (SELECT *, (y - yhat) - avg(y - yhat) OVER (PARTITION BY series, model) AS d FROM fc),
acf AS ({_LAGS}), arr AS (SELECT series, model, list(acf ORDER BY lag) AS r FROM acf GROUP BY series, model),
dl AS (
  SELECT series, model, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, 1.0::DOUBLE AS last FROM arr
  UNION ALL
  SELECT series, model, r, k + 1, list_append(list_transform(phi, lambda x, i: x - v * phi[k + 1 - i]), v), v FROM (
    SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda x, i: x * r[k + 2 - i])), 0))
      / (1 - coalesce(list_sum(list_transform(phi, lambda x, i: x * r[i + 1])), 0)) AS v FROM dl WHERE k < 10))
SELECT series, model, CAST(k AS INTEGER) AS lag, round(r[k + 1], 6) AS acf, round(last, 6) AS pacf FROM dl""")
def ts_acf(spark, sf_dir):
    return rounded(timeseries.autocorrelation(_both(weekly_parts(spark, sf_dir)), 10), 6)


@query("ts_seasonality", f"""WITH {SALES}, {series_sql('D', 'category', drop_zero_runs=True)}
SELECT series, 'month' AS pattern, CAST(month(period) AS INTEGER) AS bucket, round(avg(value), 2) AS value FROM ts GROUP BY ALL
UNION ALL SELECT series, 'weekday', CAST(isodow(period) - 1 AS INTEGER), round(avg(value), 2) FROM ts GROUP BY series, isodow(period)
UNION ALL SELECT series, 'overall_mean', NULL, round(avg(value), 2) FROM ts GROUP BY series
UNION ALL SELECT series, 'overall_std', NULL, round(stddev_samp(value), 2) FROM ts GROUP BY series""")
def ts_seasonality(spark, sf_dir):
    return rounded(timeseries.seasonality(prepared(spark, sf_dir, "D", "category")), 2)


# Monthly sales per category, the last 12 months held out, smoothing fixed.
_ALPHA, _BETA, _GAMMA, _PHI = 0.3, 0.1, 0.2, 0.9


def _holt_winters_sql(add):
    apart, join = ("{y} - {s}", "{x} + {s}") if add else ("{y} / {s}", "{x} * {s}")
    ahead = f"(level + {_PHI} * trend)"
    return f"""WITH RECURSIVE {SALES}, {series_sql('M', 'category', drop_zero_runs=True)}, {split_sql(12)},
train AS (SELECT series, list(value ORDER BY period) AS ys FROM parts WHERE part = 'train' GROUP BY series),
begin AS (SELECT series, ys, list_avg(ys[1:12]) AS mid, (list_avg(ys[13:24]) - list_avg(ys[1:12])) / 12 AS b FROM train),
hw AS (
  SELECT series, ys, 0 AS t, mid - 6.5 * b AS level, b AS trend,
         list_transform(ys[1:12], lambda y, i: {apart.format(y='y', s='(mid + b * (i - 6.5))')}) AS seasons FROM begin
  UNION ALL
  SELECT series, ys, t + 1, nl, {_BETA} * (nl - level) + (1 - {_BETA}) * {_PHI} * trend,
         list_append(seasons[2:12], {_GAMMA} * ({apart.format(y='ys[t + 1]', s=ahead)}) + (1 - {_GAMMA}) * seasons[1])
  FROM (SELECT *, {_ALPHA} * ({apart.format(y='ys[t + 1]', s='seasons[1]')}) + (1 - {_ALPHA}) * {ahead} AS nl FROM hw WHERE t < len(ys))),
fin AS (SELECT * FROM hw WHERE t = len(ys)),
held AS (SELECT series, period, value AS y, row_number() OVER (PARTITION BY series ORDER BY period) AS h FROM parts WHERE part = 'test')
SELECT h.series, period, 'HoltWinters' AS model, round(y, 2) AS y,
       round({join.format(x=f"(level + {_PHI} * (1 - pow({_PHI}, h)) / (1 - {_PHI}) * trend)", s="seasons[(h - 1) % 12 + 1]")}, 2) AS yhat
FROM held h JOIN fin f ON f.series = h.series"""


def monthly_parts(spark, sf_dir):
    return timeseries.split(prepared(spark, sf_dir, "M", "category"), 12)


@query("ts_holt_winters", _holt_winters_sql(True))
def ts_holt_winters(spark, sf_dir):
    grid = [(_ALPHA, _BETA, _GAMMA, _PHI)]
    return rounded(forecast.holt_winters(monthly_parts(spark, sf_dir), "add", 12, grid), 2)


@query("ts_holt_winters_mul", _holt_winters_sql(False))
def ts_holt_winters_mul(spark, sf_dir):
    grid = [(_ALPHA, _BETA, _GAMMA, _PHI)]
    return rounded(forecast.holt_winters(monthly_parts(spark, sf_dir), "mul", 12, grid), 2)


@query("ts_holt_winters_search")
def ts_holt_winters_search(spark, sf_dir):
    return forecast.holt_winters(monthly_parts(spark, sf_dir))


def swept_sql(matrix, size, pivot):
    """One Gauss-Jordan sweep of a matrix held as a list; ``g0`` is its first entry before any sweep."""
    p = f"{matrix}[{pivot} * {size} + {pivot} + 1]"
    return f"""list_transform({matrix}, lambda v, c: CASE
    WHEN {p} <= 1e-12 * g0 THEN CASE WHEN (c - 1) // {size} = {pivot} OR (c - 1) % {size} = {pivot} THEN 0 ELSE v END
    WHEN (c - 1) // {size} = {pivot} AND (c - 1) % {size} = {pivot} THEN 1 / {p}
    WHEN (c - 1) // {size} = {pivot} THEN v / {p} WHEN (c - 1) % {size} = {pivot} THEN -v / {p}
    ELSE v - {matrix}[(c - 1) // {size} * {size} + {pivot} + 1] * {matrix}[{pivot} * {size} + (c - 1) % {size} + 1] / {p} END)"""


def arima_sql(p, d, q):
    """CTE ``models`` (series, p, d, q, n, sigma2, bic, phi, z, level, mean, ar, ma) over the CTE ``parts``, by normal equations."""
    top_p, top_q = max(p), max(q)
    long = max(top_p, top_q) + 4
    lags = long + top_q
    size, m = lags + 1, 1 + top_p + top_q
    z = {0: "w0 - mean AS z, 0.0::DOUBLE AS level, mean", 1: "w1 AS z, w0 AS level, 0.0::DOUBLE AS mean"}
    shifts = ", ".join(f"lag(z, {k}) OVER w" for k in range(size))
    sums = ", ".join(f"sum(zs[{i + 1}] * zs[{j + 1}])" for i in range(size) for j in range(size))
    rows = [f"[{', '.join('1.0' if k == i else '0.0' for k in range(size))}]" for i in range(top_p + 1)] + [
        "[" + ", ".join(["0.0"] * j + ["1.0"] + [f"-phi[{k}]" for k in range(1, long + 1)] + ["0.0"] * (size - j - 1 - long)) + "]"
        for j in range(1, top_q + 1)]
    orders = ", ".join(
        f"({i}, {j}, CAST({[*range(1, i + 1), *range(top_p + 1, top_p + 1 + j)]} AS INTEGER[]))" for i in p for j in q)
    weight = lambda k, used: f"CASE WHEN {used} THEN m[{k * m + 1}] ELSE 0.0 END"
    ar = ", ".join(weight(i, f"p >= {i}") for i in range(1, top_p + 1))
    ma = ", ".join(weight(top_p + j, f"q >= {j}") for j in range(1, top_q + 1))
    return f"""base0 AS (SELECT series, period, value AS w0, row_number() OVER w AS t, avg(value) OVER (PARTITION BY series) AS mean
  FROM parts WHERE part = 'train' WINDOW w AS (PARTITION BY series ORDER BY period)),
base AS (SELECT *, w0 - lag(w0) OVER (PARTITION BY series ORDER BY period) AS w1 FROM base0),
stacked AS ({' UNION ALL '.join(f"SELECT series, period, t, {k} AS d, {z[k]} FROM base" for k in d)}),
lagged AS (SELECT *, [{shifts}] AS zs FROM stacked WINDOW w AS (PARTITION BY series, d ORDER BY period)),
moments AS (SELECT series, d, count(*) AS n, [{sums}] AS g, max_by(zs, period) AS z, max_by(level, period) AS level, any_value(mean) AS mean
  FROM lagged WHERE t > {lags + max(d)} GROUP BY series, d HAVING count(*) >= {long}),
auto AS (SELECT series, d, g AS m, g[1] AS g0, 1 AS k FROM moments
  UNION ALL SELECT series, d, {swept_sql('m', size, 'k')}, g0, k + 1 FROM auto WHERE k <= {long}),
combined AS (SELECT o.*, a.phi, [{', '.join(rows)}] AS c FROM moments o JOIN (
  SELECT series, d, [{', '.join(f'm[{k * size + 1}]' for k in range(1, long + 1))}] AS phi FROM auto WHERE k = {long + 1}) a USING (series, d)),
small AS (SELECT *, list_transform(range({m * m}), lambda ab: list_sum(list_transform(range({size * size}), lambda ij:
  c[ab // {m} + 1][ij // {size} + 1] * g[ij + 1] * c[ab % {m} + 1][ij % {size} + 1]))) AS s FROM combined),
orders(p, q, pivots) AS (VALUES {orders}),
fits AS (SELECT series, d, p, q, pivots, s AS m, g[1] AS g1, s[1] AS g0, 1 AS k FROM small, orders
  UNION ALL SELECT series, d, p, q, pivots, {swept_sql('m', m, 'pivots[k]')}, g1, g0, k + 1 FROM fits WHERE k <= len(pivots)),
models AS (SELECT *, n * ln(greatest(sigma2, 1e-300)) + (p + q + CASE WHEN d = 0 THEN 1 ELSE 0 END) * ln(n) AS bic FROM (
  SELECT series, d, p, q, n, greatest(m[1], 1e-12 * g1) / n AS sigma2, phi, z, level, mean,
    CAST([{ar}] AS DOUBLE[]) AS ar, CAST([{ma}] AS DOUBLE[]) AS ma
  FROM (SELECT * FROM fits WHERE k = len(pivots) + 1) JOIN small USING (series, d)))"""


def paths_sql(models):
    """CTE ``paths`` (series, h, yhat) for twelve periods after one model for each series."""
    dot = lambda a, b: f"coalesce(list_sum(list_transform({a}, lambda x, i: x * {b}[i])), 0)"
    push = lambda value, old: f"CASE WHEN len({old}) > 0 THEN list_prepend({value}, {old}[1:len({old}) - 1]) ELSE {old} END"
    return f"""steps AS (
  SELECT series, d, level, mean, ar, ma, z[1:len(ar)] AS zs,
    list_transform(ma, lambda _, j: z[j] - list_sum(list_transform(phi, lambda x, i: x * z[j + i]))) AS es, 0 AS h, 0.0::DOUBLE AS new FROM {models}
  UNION ALL
  SELECT series, d, level, mean, ar, ma, {push('v', 'zs')}, {push('0.0', 'es')}, h + 1, v
  FROM (SELECT *, {dot('ar', 'zs')} + {dot('ma', 'es')} AS v FROM steps WHERE h < 12)),
paths AS (SELECT series, h, CASE WHEN d = 0 THEN new + mean ELSE level + sum(new) OVER (PARTITION BY series ORDER BY h) END AS yhat
  FROM steps WHERE h > 0),
held AS (SELECT series, period, value AS y, row_number() OVER (PARTITION BY series ORDER BY period) AS h FROM parts WHERE part = 'test')"""


_FORECASTS = """SELECT h.series, period, 'ARIMA' AS model, round(y, 2) AS y, round(yhat, 2) AS yhat
FROM held h LEFT JOIN paths p ON p.series = h.series AND p.h = h.h"""
_GRID = arima_sql([0, 1, 2], [0, 1], [0, 1, 2])
_WEEKLY_RECURSIVE = _WEEKLY.replace("WITH", "WITH RECURSIVE", 1)
_MONTHLY_RECURSIVE = f"WITH RECURSIVE {SALES}, {series_sql('M', 'category', drop_zero_runs=True)}, {split_sql(12)}"


@query("ts_arima", f"{_WEEKLY_RECURSIVE}, {arima_sql([1], [1], [1])}, {paths_sql('models')} {_FORECASTS}")
def ts_arima(spark, sf_dir):
    return rounded(forecast.arima(weekly_parts(spark, sf_dir), (1, 1, 1)), 2)


@query("ts_arima_search", f"""{_WEEKLY_RECURSIVE}, {_GRID} SELECT series, p, d, q, n, round(ln(sigma2), 6) AS log_variance, round(bic, 4) AS bic,
  row_number() OVER (PARTITION BY series ORDER BY bic, d, p, q) = 1 AS chosen FROM models""")
def ts_arima_search(spark, sf_dir):
    table = forecast.arima_search(weekly_parts(spark, sf_dir)).withColumn("log_variance", F.ln("sigma2")).drop("sigma2")
    return rounded(rounded(table, 6, ["log_variance"]), 4, ["bic"])


@query("ts_arima_best", f"""{_MONTHLY_RECURSIVE}, {_GRID}, best AS (
  SELECT * FROM models QUALIFY row_number() OVER (PARTITION BY series ORDER BY bic, d, p, q) = 1), {paths_sql('best')} {_FORECASTS}""")
def ts_arima_best(spark, sf_dir):
    return rounded(forecast.best_arima(monthly_parts(spark, sf_dir)), 2)


@query("ts_arima_seasonal")
def ts_arima_seasonal(spark, sf_dir):
    return forecast.arima(monthly_parts(spark, sf_dir), (1, 0, 1), (1, 1, 1, 12))


@query("ts_fourier")
def ts_fourier(spark, sf_dir):
    return forecast.fourier(weekly_parts(spark, sf_dir))


@query("ts_trend_breaks")
def ts_trend_breaks(spark, sf_dir):
    return forecast.trend_breaks(weekly_parts(spark, sf_dir))


_BREAKS, _RIDGE = ["1996-09-30", "1998-04-01", "2000-01-15"], 0.01


def _trend_sql():
    """Ridge regression on intercept, trend, ten yearly pairs and three given breaks, by normal equations."""
    waves = [f"{f}(2 * pi() * {k} * day / 365.25)" for k in range(1, 11) for f in ("sin", "cos")]
    hinges = [f"greatest(day - date_diff('day', DATE '1970-01-01', DATE '{b}'), 0) / 365.25" for b in _BREAKS]
    design = ["1.0::DOUBLE", "(day - origin) / 365.25", *waves, *hinges]
    size = len(design) + 1
    sums = ", ".join(
        f"sum(x[{i + 1}] * x[{j + 1}])" + (f" + {_RIDGE}" if i == j and 0 < i < size - 1 else "") for i in range(size) for j in range(size))
    return f"""{_WEEKLY_RECURSIVE}, dated AS (
  SELECT *, date_diff('day', DATE '1970-01-01', period) AS day, min(date_diff('day', DATE '1970-01-01', period)) OVER (PARTITION BY series) AS origin FROM parts),
designed AS (SELECT series, period, part, value, [{', '.join(design)}, value] AS x FROM dated),
fit AS (SELECT series, [{sums}] AS m, 1.0 AS g0, 0 AS k FROM designed WHERE part = 'train' GROUP BY series
  UNION ALL SELECT series, {swept_sql('m', size, 'k')}, g0, k + 1 FROM fit WHERE k < {size - 1}),
weights AS (SELECT series, list_transform(range({size - 1}), lambda i: m[i * {size} + {size}]) AS w FROM fit WHERE k = {size - 1})
SELECT d.series, period, 'Fourier' AS model, round(value, 2) AS y, round(list_sum(list_transform(w, lambda b, i: b * x[i])), 2) AS yhat
FROM designed d JOIN weights USING (series) WHERE part = 'test'"""


@query("ts_fourier_given_breaks", _trend_sql())
def ts_fourier_given_breaks(spark, sf_dir):
    return rounded(forecast.fourier(weekly_parts(spark, sf_dir), True, False, _RIDGE, _BREAKS), 2)


@query("ts_compare_all")
def ts_compare_all(spark, sf_dir):
    parts = weekly_parts(spark, sf_dir)
    every = _both(parts)
    for model in (forecast.arima(parts), forecast.holt_winters(parts), forecast.fourier(parts)):
        every = every.unionByName(model)
    return timeseries.with_errors(forecast_metrics(every)).orderBy("series", F.asc_nulls_last("mae"), "model")
