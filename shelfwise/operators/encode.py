"""Encoding, scaling and date parts."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.functions.lookup import left_lookup
from shelfwise.functions.ordered import row_numbers
from shelfwise.functions.quantiles import exact_quantiles
from shelfwise.functions.shape import column_values
from shelfwise.functions.storage import cut

# Season of each month (fixed values).
SEASONS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
}
HOLIDAY_MONTHS = [11, 12]


def label_map(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """(column, code): codes from 0 in order of first appearance of the non-null values."""
    first = cut(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(F.struct(*order)).alias("_first")))
    return row_numbers(first, [], ["_first"], "_place").select(column, (F.col("_place") - 1).cast("int").alias("code"))


def encode_label(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``<column>_encoded``; null gets -1."""
    for c in (c for c in columns if c in df.columns):
        codes = label_map(df, c, order).withColumnRenamed("code", "_code")
        df = left_lookup(df, codes, c).withColumn(f"{c}_encoded", F.coalesce("_code", F.lit(-1))).drop("_code")
    return df


def encode_onehot(df: DataFrame, columns: Sequence[str], values: dict[str, Sequence] | None = None) -> DataFrame:
    """Adds boolean ``<column>_<value>`` for every value but the first in sort order; null rows are all false.

    ``values`` names the values of a column in advance, which saves the pass that looks for them; for
    columns with very many values use ``onehot_flags``.
    """
    for c in (c for c in columns if c in df.columns):
        known = list(values[c]) if values and c in values else column_values(df, c)
        flags = {f"{c}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)) for v in known[1:]}
        df = df.withColumns(flags) if flags else df
    return df


def onehot_flags(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The one-hot columns in long form, for any number of values: (*key, column, value) where the flag is true.

    As in the wide form the first value in sort order of a column has no flag, and null rows have none.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError("no such column")
    first = df.agg(F.struct(*[F.min(c).alias(c) for c in present]).alias("first")).scalar()
    cells = [F.struct(F.lit(c).alias("column"), F.when(F.col(c) > first[c], F.col(c).cast("string")).alias("value")) for c in present]
    return df.select(*key, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def encode_categorical(df: DataFrame, columns: Sequence[str], method: str = "label", order: Sequence[str] = ()) -> DataFrame:
    if method == "label":
        return encode_label(df, columns, order)
    if method == "onehot":
        return encode_onehot(df, columns)
    raise ValueError(f"unknown encoding method: {method}")


def encode_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_freq``: the value's share among the non-null rows; null stays null."""
    for c in (c for c in columns if c in df.columns):
        counts = cut(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n")))
        total = counts.agg(F.sum("_n").alias("n")).scalar()
        df = left_lookup(df, counts.select(c, (F.col("_n") / total).alias(f"{c}_freq")), c)
    return df


def scale(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """Adds ``<column>_scaled``: standard (population deviation), minmax or robust. A spread of 0 counts as 1."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    if method == "robust":
        quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        spans = {c: (F.lit(q[1]), F.lit((q[2] - q[0]) or 1.0)) for c, q in quartiles.items() if q[1] is not None}
    elif method in ("standard", "minmax"):
        lowest = F.avg if method == "standard" else F.min
        width = F.stddev_pop if method == "standard" else (lambda c: F.max(c) - F.min(c))
        stats = df.agg(F.struct(*[
            f(F.col(c).cast("double")).alias(f"{part}_{c}") for c in columns for part, f in (("from", lowest), ("by", width))
        ]).alias("stats")).scalar()
        spans = {
            c: (stats[f"from_{c}"], F.when(stats[f"by_{c}"] == 0, 1.0).otherwise(stats[f"by_{c}"])) for c in columns
        }
    else:
        raise ValueError(f"unknown scaling method: {method}")
    return df.withColumns({f"{c}_scaled": (F.col(c) - start) / by for c, (start, by) in spans.items()})


def _as_time(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("timestamp_ntz")
    return F.col(column)


def process_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds year, month, quarter, day, dayofweek (Monday 0) and is_weekend; unreadable text becomes null."""
    for c in (c for c in columns if c in df.columns):
        df = df.withColumn(c, _as_time(df, c))
        df = df.withColumns({
            f"{c}_year": F.year(c),
            f"{c}_month": F.month(c),
            f"{c}_quarter": F.quarter(c),
            f"{c}_day": F.day(c),
            f"{c}_dayofweek": F.weekday(c),
            f"{c}_is_weekend": F.coalesce(F.weekday(c) >= 5, F.lit(False)).cast("int"),
        })
    return df


def time_features(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Calendar, cyclical, season and holiday-season columns of a date column."""
    if date_col not in df.columns:
        raise ValueError(f"column {date_col} not found")
    month, weekday = F.month(date_col), F.weekday(date_col)
    seasons = F.create_map(*[F.lit(x) for name, months in SEASONS.items() for m in months for x in (m, name)])
    turn = lambda part, length: part * (2 * pi) / length
    return df.withColumns({
        "year": F.year(date_col),
        "month": month,
        "quarter": F.quarter(date_col),
        "day": F.day(date_col),
        "day_of_week": weekday,
        "week_of_year": F.weekofyear(date_col),
        "month_sin": F.sin(turn(month, 12)),
        "month_cos": F.cos(turn(month, 12)),
        "day_of_week_sin": F.sin(turn(weekday, 7)),
        "day_of_week_cos": F.cos(turn(weekday, 7)),
        "is_weekend": F.coalesce(weekday >= 5, F.lit(False)).cast("int"),
        "season": seasons[month],
        "is_holiday_season": F.coalesce(month.isin(HOLIDAY_MONTHS), F.lit(False)).cast("int"),
    })
