"""Regular time series: (series, period, value), one row per period of each series.

A series is at most as long as its calendar, so windows and arrays per series stay small;
many series are worked on at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.quantiles import grouped_medians
from shelfwise.operators.metrics import forecast_metrics

ALL = "all"

AGGREGATES = {
    "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp,
}


def period_label(day: Column, freq: str) -> Column:
    """D: the day. W: the Sunday that ends the week. M: the last day of the month."""
    if freq == "D":
        return day
    if freq == "W":
        return F.next_day(F.date_sub(day, 1), "SUN")
    if freq == "M":
        return F.last_day(day)
    raise ValueError("freq must be 'D', 'W' or 'M'")


def _until_next(freq: str, period: Column, following: Column) -> Column:
    """The period and the empty ones up to the following period with rows."""
    if freq == "M":
        month = F.trunc(period, "month")
        last = F.coalesce(F.add_months(F.trunc(following, "month"), -1), month)
        return F.transform(F.sequence(month, last, F.expr("INTERVAL 1 MONTH")), lambda m: F.last_day(m))
    days = 7 if freq == "W" else 1
    return F.sequence(period, F.coalesce(F.date_sub(following, days), period), F.expr(f"INTERVAL {days} DAYS"))


def resample(
    df: DataFrame, date_col: str, value_col: str, freq: str = "W", agg_func: str = "sum", series_col: str | None = None
) -> DataFrame:
    """Aggregates values by period; periods without rows, between the first and the last, are 0."""
    series = F.lit(ALL) if series_col is None else F.col(series_col).cast("string")
    rows = df.where(F.col(date_col).isNotNull()).select(
        series.alias("series"), period_label(F.to_date(date_col), freq).alias("period"), F.col(value_col).alias("v")
    ).where(F.col("series").isNotNull())
    if agg_func == "median":
        seen = rows.groupBy("series", "period").agg(F.count("*").alias("_rows"))
        values = seen.join(grouped_medians(rows, ["series", "period"], "v", "value"), ["series", "period"], "left").drop("_rows")
    elif agg_func in AGGREGATES:
        values = rows.groupBy("series", "period").agg(AGGREGATES[agg_func]("v").cast("double").alias("value"))
    else:
        raise ValueError(f"agg_func must be 'median' or one of {sorted(AGGREGATES)}")
    following = F.lead("period").over(Window.partitionBy("series").orderBy("period"))
    filled = values.withColumn("_next", following).select(
        "series", "value", F.posexplode(_until_next(freq, F.col("period"), F.col("_next"))).alias("_gap", "period")
    )
    return filled.select(
        "series", "period", F.when(F.col("_gap") == 0, F.coalesce("value", F.lit(0.0))).otherwise(0.0).alias("value")
    )


def prepare_time_series(
    df: DataFrame,
    date_col: str = "order_date",
    value_col: str = "sales",
    agg_func: str = "sum",
    *,
    freq: str = "W",
    series_col: str | None = None,
) -> DataFrame:
    """``resample`` with every run of zeros cut down to its first period."""
    window = Window.partitionBy("series").orderBy("period")
    before = F.lag("value").over(window)
    return (
        resample(df, date_col, value_col, freq, agg_func, series_col)
        .withColumn("_before", before)
        .where((F.col("value") != 0) | F.col("_before").isNull() | (F.col("_before") != 0))
        .drop("_before")
    )


def split(ts: DataFrame, n_test: int | None = None, test_size: float = 0.2) -> DataFrame:
    """Adds ``part``: the last ``n_test`` periods of each series (default: a share of them) are 'test'."""
    whole = Window.partitionBy("series")
    held = F.floor(F.count("*").over(whole) * test_size) if n_test is None else F.lit(n_test)
    from_end = F.row_number().over(whole.orderBy(F.desc("period")))
    return ts.withColumn("part", F.when(from_end <= held, "test").otherwise("train"))


def train_part(parts: DataFrame) -> DataFrame:
    return parts.where("part = 'train'").drop("part")


def test_part(parts: DataFrame) -> DataFrame:
    return parts.where("part = 'test'").drop("part")


def _constant(parts: DataFrame, per_series: DataFrame, model: str) -> DataFrame:
    return test_part(parts).join(per_series, "series").select(
        "series", "period", F.lit(model).alias("model"), F.col("value").alias("y"), "yhat"
    )


def naive(parts: DataFrame) -> DataFrame:
    """(series, period, model, y, yhat): the last training value, repeated."""
    last = train_part(parts).groupBy("series").agg(F.max_by("value", "period").alias("yhat"))
    return _constant(parts, last, "Naive")


def moving_average(parts: DataFrame, window: int = 4) -> DataFrame:
    """The mean of the last ``window`` training values, repeated."""
    newest = F.row_number().over(Window.partitionBy("series").orderBy(F.desc("period")))
    recent = train_part(parts).withColumn("_n", newest).where(F.col("_n") <= window)
    return _constant(parts, recent.groupBy("series").agg(F.avg("value").alias("yhat")), f"MA_{window}")


def compare_forecasts(forecasts: DataFrame) -> DataFrame:
    """(series, model, mae, rmse, smape, mape), lowest mae first in each series."""
    return forecast_metrics(forecasts).select("series", "model", "mae", "rmse", "smape", "mape").orderBy(
        "series", "mae", "model"
    )


def with_errors(comparison: DataFrame) -> DataFrame:
    """Adds ``error``: a sentence for each model that could not be fitted to a series, else null."""
    said = F.format_string("%s could not be fitted to so few periods", "model")
    return comparison.withColumn("error", F.when(F.col("mae").isNull(), said))


def residual_stats(forecasts: DataFrame) -> DataFrame:
    """(series, model, mean, std, min, max) of y - yhat, with the population deviation."""
    r = F.col("y") - F.col("yhat")
    return forecasts.groupBy("series", "model").agg(
        F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), F.min(r).alias("min"), F.max(r).alias("max")
    )


def autocorrelation(forecasts: DataFrame, lags: int = 10) -> DataFrame:
    """(series, model, lag, acf, pacf) of the residuals; lags reach at most the length less one.

    The partial autocorrelations come from the autocorrelations by the Durbin-Levinson recursion.
    """
    keys = ["series", "model"]
    centred = forecasts.select(*keys, "period", (F.col("y") - F.col("yhat")).alias("r"))
    d = F.col("r") - F.avg("r").over(Window.partitionBy(*keys))
    centred = centred.withColumn("d", d)
    window = Window.partitionBy(*keys).orderBy("period")
    products = centred.withColumns({f"p{k}": F.col("d") * F.lag("d", k).over(window) for k in range(1, lags + 1)})
    variance = F.sum(F.col("d") * F.col("d"))
    acf = products.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.array(F.lit(1.0), *[F.try_divide(F.sum(f"p{k}"), variance) for k in range(1, lags + 1)]).alias("acf"),
    ).withColumn("acf", F.slice("acf", 1, F.least(F.col("n"), F.lit(lags + 1))))

    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def step(state, k):
        phi, r = state["phi"], F.col("acf")
        past = F.slice(r, 2, k - 1)  # r1 .. r(k-1)
        new = (F.element_at(r, (k + 1).cast("int")) - dot(phi, F.reverse(past))) / (1 - dot(phi, past))
        kept = F.zip_with(phi, F.reverse(phi), lambda a, b: a - new * b)
        return F.struct(
            F.concat(kept, F.array(new)).alias("phi"), F.concat(state["pacf"], F.array(new)).alias("pacf")
        )

    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.array(F.lit(1.0)).alias("pacf"))
    orders = F.when(F.size("acf") > 1, F.sequence(F.lit(1), F.size("acf") - 1)).otherwise(F.array().cast("array<int>"))
    pacf = F.aggregate(orders, start, step, lambda state: state["pacf"])
    return acf.select(*keys, F.posexplode(F.arrays_zip("acf", pacf.alias("pacf"))).alias("lag", "v")).select(
        *keys, "lag", F.col("v.acf").alias("acf"), F.col("v.pacf").alias("pacf")
    )


def seasonality(ts: DataFrame) -> DataFrame:
    """(series, pattern, bucket, value): mean by month and by weekday (Monday 0), overall mean and deviation."""
    table = ts.select("series", "value", F.month("period").alias("month"), F.weekday("period").alias("weekday"))
    sets = table.groupingSets(
        [["series", "month"], ["series", "weekday"], ["series"]], "series", "month", "weekday"
    ).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.grouping("month").alias("_m"), F.grouping("weekday").alias("_w"),
    )
    row = lambda pattern, bucket, value: F.struct(
        F.lit(pattern).alias("pattern"), bucket.alias("bucket"), value.alias("value"))
    none = F.lit(None).cast("int")
    return sets.select("series", F.inline(
        F.when(F.col("_m") == 0, F.array(row("month", F.col("month"), F.col("mean"))))
        .when(F.col("_w") == 0, F.array(row("weekday", F.col("weekday"), F.col("mean"))))
        .otherwise(F.array(row("overall_mean", none, F.col("mean")), row("overall_std", none, F.col("std"))))
    ))
