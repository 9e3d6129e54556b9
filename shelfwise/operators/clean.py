"""Cleaning: missing values, duplicates, outliers, casts, and the combined preprocessing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.functions.lookup import BROADCAST_ROWS, modes
from shelfwise.functions.quantiles import exact_quantiles
from shelfwise.functions.storage import cut
from shelfwise.functions.shape import numeric_columns, stacked, text_columns
from shelfwise.operators.encode import encode_label, process_dates, scale
from shelfwise.operators.profile import null_counts

UNKNOWN = "Unknown"


def _null_ratios(df: DataFrame) -> dict[str, float]:
    row = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return {c: row[c] / row["_rows"] if row["_rows"] else 0.0 for c in df.columns}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Drops columns whose share of nulls exceeds the threshold."""
    return df.drop(*[c for c, ratio in _null_ratios(df).items() if ratio > threshold])


def handle_missing(
    df: DataFrame, numeric_strategy: str = "median", categorical_strategy: str = "mode", threshold: float = 0.3,
    *, written: bool = False,
) -> DataFrame:
    """Drops sparse columns, then fills numbers by mean, median or mode and text by mode or 'Unknown'.

    Dates are never filled. Whole-number columns with gaps become doubles. ``written``: ``df`` reads a written table.
    """
    ratios = _null_ratios(df)
    df = df.drop(*[c for c, ratio in ratios.items() if ratio > threshold])
    gappy = {c for c, ratio in ratios.items() if 0 < ratio <= threshold}
    numbers = [c for c in numeric_columns(df) if c in gappy]
    texts = [c for c in text_columns(df) if c in gappy]

    fills: dict[str, float | str | None] = {}
    if numeric_strategy == "mean" and numbers:
        fills.update(df.agg(*[F.avg(c).alias(c) for c in numbers]).first().asDict())
    elif numeric_strategy == "median":
        fills.update({c: q[0] for c, q in exact_quantiles(df, numbers, [0.5], written=written).items()})
    elif numbers:
        found = modes(df, numbers)
        fills.update({c: found.get(c, 0.0) for c in numbers})
    found = modes(df, texts) if texts and categorical_strategy == "mode" else {}
    fills.update({c: found.get(c, UNKNOWN) for c in texts})

    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    widened = {
        c: F.col(c).cast("double") for c in numbers if isinstance(df.schema[c].dataType, whole)
    }
    filled = {
        c: F.coalesce(widened.get(c, F.col(c)), F.lit(v)) for c, v in fills.items() if v is not None
    }
    return df.withColumns(filled) if filled else df


def drop_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first", order: Sequence[str] = ()
) -> DataFrame:
    """Keeps the first or last row, or with ``keep=False`` no row, of each set of duplicates.

    Nulls equal nulls. ``order`` says what first and last mean. This is an aggregation, not a
    window: each task keeps one row per key, so a key holding most rows stays cheap.
    """
    columns = df.columns
    keys = list(subset or columns)
    ordered = [*order, *[c for c in columns if c not in set(order)]]
    row = F.struct(*ordered)
    if keep is False:
        lone = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
            F.min(row).alias("row"), F.count("*").alias("n")
        ).where("n = 1")
    elif keep in ("first", "last"):
        pick = F.min if keep == "first" else F.max
        lone = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(pick(row).alias("row"))
    else:
        raise ValueError("keep must be 'first', 'last' or False")
    return lone.select("row.*").select(*columns)


def first_of_each(df: DataFrame, subset: Sequence[str] | None, order: Sequence[str]) -> DataFrame:
    """``drop_duplicates`` to the first row, for rows of a written table: only those that may be duplicates are moved.

    Equal keys have equal hashes, so a row whose hash occurs once stays where it is. With more than ``BROADCAST_ROWS``
    hashes that occur again, all rows are grouped and written.
    """
    keyed = df.withColumn("_hash", F.xxhash64(*(subset or df.columns)))
    again = cut(keyed.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash"))
    n = again.count()
    if n > BROADCAST_ROWS:
        return cut(drop_duplicates(df, subset, "first", order))
    if not n:
        return df
    part = lambda how: keyed.join(F.broadcast(again), "_hash", how).select(*df.columns)
    return part("left_anti").unionByName(cut(drop_duplicates(part("left_semi"), subset, "first", order)))


def duplicates_removed(df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first") -> DataFrame:
    """(duplicates_removed): how many rows ``drop_duplicates`` takes away."""
    n = F.col("n")
    lost = F.when(n > 1, n).otherwise(0) if keep is False else n - 1
    groups = df.groupBy(*(subset or df.columns)).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(lost), F.lit(0)).cast("long").alias("duplicates_removed"))


def _iqr_bounds(df: DataFrame, columns: Sequence[str], threshold: float) -> dict[str, tuple[float, float]]:
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    return {
        c: (low - threshold * (high - low), high + threshold * (high - low))
        for c, (low, high) in quartiles.items()
        if low is not None
    }


def _clipped(column: str, low: Column, high: Column) -> Column:
    x = F.col(column)
    return F.when(x.isNotNull(), F.greatest(F.least(x, high), low))


def outliers_iqr(
    df: DataFrame, columns: Sequence[str], threshold: float = 1.5, method: str = "clip"
) -> DataFrame:
    """Clips, removes or blanks values beyond ``threshold`` interquartile ranges from the quartiles.

    With ``method='remove'`` the columns are taken in order, each on the rows the earlier ones
    left, and rows where the column is null go too; clip and NaN leave nulls alone.
    """
    columns = [c for c in columns if c in df.columns]
    if method == "remove":
        for c in columns:
            for low, high in _iqr_bounds(df, [c], threshold).values():
                df = df.where(F.col(c).between(low, high))
        return df
    if method not in ("clip", "NaN"):
        raise ValueError("method must be 'clip', 'remove' or 'NaN'")
    bounds = _iqr_bounds(df, columns, threshold)
    changed = {
        c: _clipped(c, F.lit(low), F.lit(high)) if method == "clip" else F.when(F.col(c).between(low, high), F.col(c))
        for c, (low, high) in bounds.items()
    }
    return df.withColumns(changed) if changed else df


def iqr_outlier_counts(
    df: DataFrame, columns: Sequence[str], threshold: float = 1.5, method: str = "clip"
) -> DataFrame:
    """(column, outliers): values out of bounds; for 'remove' the rows each column takes away."""
    spark = df.sparkSession
    columns = [c for c in columns if c in df.columns]
    if method == "remove":
        tallies = []
        for c in columns:
            for low, high in _iqr_bounds(df, [c], threshold).values():
                inside = F.col(c).between(low, high)
                lost = F.count_if(~F.coalesce(inside, F.lit(False)))
                tallies.append(df.agg(F.lit(c).alias("column"), lost.alias("outliers")))
                df = df.where(inside)
        result = tallies[0] if tallies else spark.createDataFrame([], "column string, outliers long")
        for extra in tallies[1:]:
            result = result.unionByName(extra)
        return result
    bounds = _iqr_bounds(df, columns, threshold)
    one = df.agg(*[
        F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c) for c, (low, high) in bounds.items()
    ])
    return stacked(one, [(c, F.col(c)) for c in bounds], ["column", "outliers"])


def _zscore(df: DataFrame, column: str) -> tuple[Column, Column]:
    """Standard score with nulls taken as 0 and the population deviation, and the plain statistics."""
    filled = F.coalesce(F.col(column), F.lit(0.0))
    stats = df.agg(F.struct(
        F.avg(filled).alias("centre"), F.stddev_pop(filled).alias("spread"),
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
    ).alias("stats")).scalar()
    score = F.when(stats["spread"] > 0, F.abs(filled - stats["centre"]) / stats["spread"]).otherwise(0.0)
    return score, stats


def outliers_zscore(
    df: DataFrame, columns: Sequence[str], threshold: float = 3.0, method: str = "clip"
) -> DataFrame:
    """Clips, removes or blanks values more than ``threshold`` deviations from the mean.

    Rows are flagged with nulls as 0 and the population deviation; clipping uses the mean and the
    sample deviation of the non-null values. 'remove' goes column by column on the rows left.
    """
    if method not in ("clip", "remove", "NaN"):
        raise ValueError("method must be 'clip', 'remove' or 'NaN'")
    base, changed = df, {}
    for c in (c for c in columns if c in df.columns):
        score, stats = _zscore(df if method == "remove" else base, c)
        if method == "remove":
            df = cut(df.where(score <= threshold))  # the next column's statistics read these rows, not all steps before
        elif method == "clip":
            reach = stats["std"] * threshold
            changed[c] = _clipped(c, stats["mean"] - reach, stats["mean"] + reach)
        else:
            changed[c] = F.when(score <= threshold, F.col(c))
    return df.withColumns(changed) if changed else df


def zscore_outlier_counts(
    df: DataFrame, columns: Sequence[str], threshold: float = 3.0, method: str = "clip"
) -> DataFrame:
    """(column, outliers): flagged rows per column; for 'remove' among the rows left by earlier columns."""
    result = None
    for c in (c for c in columns if c in df.columns):
        score, _ = _zscore(df, c)
        tally = df.agg(F.lit(c).alias("column"), F.count_if(score > threshold).alias("outliers"))
        result = tally if result is None else result.unionByName(tally)
        if method == "remove":
            df = cut(df.where(score <= threshold))
    if result is None:
        return df.sparkSession.createDataFrame([], "column string, outliers long")
    return result


def convert_types(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Casts columns: 'datetime' and 'numeric' turn what cannot be read into null, 'category' is text,
    anything else is a strict cast to that SQL type."""
    changed = {}
    for name, kind in mapping.items():
        if name not in df.columns:
            continue
        if kind == "datetime":
            changed[name] = F.col(name).cast("string").try_cast("timestamp_ntz")
        elif kind == "numeric":
            changed[name] = F.col(name).try_cast("double")
        elif kind == "category":
            changed[name] = F.col(name).cast("string")
        else:
            changed[name] = F.col(name).cast(kind)
    return df.withColumns(changed) if changed else df


def preprocess(
    df: DataFrame,
    numeric_cols: Sequence[str],
    categorical_cols: Sequence[str],
    date_cols: Sequence[str],
    outlier_cols: Sequence[str],
    *,
    order: Sequence[str],
    dedup_subset: Sequence[str] | None = ("order_id", "product_id"),
) -> DataFrame:
    """Missing values, duplicates, IQR clipping, date parts, label codes and standard scaling in turn."""
    df = handle_missing(cut(df), written=True)  # read again by every statistic
    df = first_of_each(df, dedup_subset, order)
    if outlier_cols:
        df = outliers_iqr(df, outlier_cols)
    if date_cols:
        df = process_dates(df, date_cols)
    df = encode_label(df, categorical_cols, order)
    return scale(df, numeric_cols, "standard")


def cleaning_report(
    df: DataFrame,
    categorical_cols: Sequence[str],
    outlier_cols: Sequence[str],
    *,
    order: Sequence[str],
    dedup_subset: Sequence[str] | None = ("order_id", "product_id"),
) -> DataFrame:
    """(metric, name, value): what each stage of ``preprocess`` up to the encoding did."""
    df = cut(df)
    filled = handle_missing(df, written=True)
    unique = first_of_each(filled, dedup_subset, order)
    clipped = outliers_iqr(unique, outlier_cols)
    encoded = [c for c in categorical_cols if c in clipped.columns]
    one = df.sparkSession.range(1)

    def line(metric, name, value):
        return [F.lit(metric).alias("metric"), F.lit(name).alias("name"), value.cast("long").alias("value")]

    nulls = lambda frame: null_counts(frame).agg(F.sum("missing").alias("missing")).scalar()
    shape = lambda metric, frame: (
        frame.agg(F.count("*").alias("n")).select(F.inline(F.array(
            F.struct(*line(metric, "rows", F.col("n"))),
            F.struct(*line(metric, "columns", F.lit(len(frame.columns)))),
        )))
    )
    report = (
        shape("original_shape", df)
        .unionByName(shape("final_shape", clipped))
        .unionByName(duplicates_removed(filled, dedup_subset).select(*line("duplicates_removed", "rows", F.col("duplicates_removed"))))
        .unionByName(one.select(*line("missing_handled", "cells", nulls(df) - nulls(filled))))
        .unionByName(
            iqr_outlier_counts(unique, outlier_cols)
            .select(F.lit("outliers_handled").alias("metric"), F.col("column").alias("name"), F.col("outliers").alias("value"))
        )
    )
    for name in encoded:
        report = report.unionByName(one.select(*line("encoded", name, F.lit(1))))
    return report
