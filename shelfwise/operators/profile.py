"""Exploratory profiling of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.lookup import BROADCAST_ROWS
from shelfwise.functions.quantiles import exact_quantiles
from shelfwise.functions.storage import cut
from shelfwise.functions.shape import (
    epoch_seconds, numeric_columns, share, stacked, text_columns, time_columns, top_per_group, value_counts,
)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(duplicates): rows that repeat an earlier identical row.

    Equal rows have equal hashes, so only rows whose hash occurs again are grouped whole; ``df`` is read twice. With more
    than ``BROADCAST_ROWS`` hashes that occur again, all rows are grouped.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    keyed = df.withColumn("_hash", F.xxhash64(F.lit(0), *hashed))
    again = cut(keyed.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash"))
    if again.count() <= BROADCAST_ROWS:
        df = keyed.join(F.broadcast(again), "_hash", "left_semi").select(*df.columns)
    repeats = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return repeats.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, missing, rows) for every column, in one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return stacked(counts, [(c, F.col(c), F.col("_rows")) for c in df.columns], ["column", "missing", "rows"])


def inspect(df: DataFrame) -> DataFrame:
    """(section, name, value): shape, types, missing values and duplicate rows."""
    df = cut(df)  # read again by every section
    as_text = lambda c: F.col(c).cast("string")
    missing = null_counts(df)
    types = dict(df.dtypes)
    dtype = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    shape = missing.agg(F.max("rows").alias("rows"), F.count("*").alias("columns"))
    return (
        stacked(shape, [("shape", "rows", as_text("rows")), ("shape", "columns", as_text("columns"))],
                ["section", "name", "value"])
        .unionByName(missing.select(F.inline(F.array(
            F.struct(F.lit("missing").alias("section"), F.col("column").alias("name"), as_text("missing").alias("value")),
            F.struct(F.lit("dtype").alias("section"), F.col("column").alias("name"), dtype[F.col("column")].alias("value")),
        ))))
        .unionByName(duplicate_rows(df).select(
            F.lit("duplicates").alias("section"), F.lit("rows").alias("name"), as_text("duplicates").alias("value")))
    )


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in a given total order."""
    return df.orderBy(*order).limit(n)


def column_info(df: DataFrame, samples: int = 3) -> DataFrame:
    """(column, dtype, non_null, nulls, distinct_values, sample_values): samples are the smallest values."""
    counts = value_counts(df, df.columns)
    present = F.col("whole").isNotNull() | F.col("num").isNotNull() | F.col("txt").isNotNull()
    summary = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("non_null"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(present).alias("distinct_values"),
    )
    shown = F.when(F.col("num").isNotNull(), F.format_string("%.2f", "num")).otherwise(F.coalesce(F.col("whole").cast("string"), "txt"))
    # Nulls are ranked last rather than filtered before, and ``n``, which decides nothing, is kept: so both uses share one count.
    smallest = (
        top_per_group(counts, ["column"], [F.desc(present), F.col("whole"), F.col("num"), F.col("txt"), F.col("n")], samples)
        .where(present)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list(F.struct("rank", shown.alias("text")))).alias("texts"))
        .select("column", F.array_join(F.col("texts.text"), ", ").alias("sample_values"))
    )
    types = dict(df.dtypes)
    dtype = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    return summary.join(smallest, "column", "left").select(
        "column", dtype[F.col("column")].alias("dtype"), "non_null", "nulls", "distinct_values", "sample_values"
    )


def summary_stats(df: DataFrame) -> DataFrame:
    """KPI strip: lines, distinct orders and customers, sales, profit and order-date range.

    Lines are first folded to one row per (order, customer), so the distinct counts run over
    the small table. Columns that are absent give 0, or null dates; orders fall back to lines.
    Amounts are summed as whole numbers, exactly up to 2**53, plus small rests, so cents do not depend on the order.
    """
    has = set(df.columns)
    keys = [c for c in ("order_id", "customer_id") if c in has]
    dated = "order_date" in has
    whole = lambda c: F.rint(F.col(c).cast("double")) if c in has else F.lit(0.0)
    rest = lambda c: F.nanvl(F.col(c).cast("double") - whole(c), F.lit(0.0)) if c in has else F.lit(0.0)
    total = lambda c: F.coalesce(F.sum(c) + F.sum(f"{c}_rest"), F.lit(0.0)).alias(f"total_{c}")
    folded = df.groupBy(*keys).agg(
        F.count("*").alias("lines"),
        *[F.sum(part(c)).alias(c + end) for c in ("sales", "profit") for part, end in ((whole, ""), (rest, "_rest"))],
        (F.min("order_date") if dated else F.lit(None).cast("timestamp")).alias("first"),
        (F.max("order_date") if dated else F.lit(None).cast("timestamp")).alias("last"),
    )
    lines = F.coalesce(F.sum("lines"), F.lit(0))
    return folded.agg(
        lines.alias("n_lines"),
        (F.count_distinct("order_id") if "order_id" in has else lines).alias("total_orders"),
        (F.count_distinct("customer_id") if "customer_id" in has else F.lit(0)).cast("long").alias("total_customers"),
        total("sales"),
        total("profit"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, *, written: bool = False) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles.

    Times are described as seconds since the epoch. ``written``: ``df`` reads a written table, so no copy is made.
    """
    columns = list(columns or [*numeric_columns(df), *time_columns(df)])
    times = set(time_columns(df))
    # Written once: exact quartiles take several passes, which need not go back to the joins behind the rows.
    numbers = df.select(*[(epoch_seconds(c) if c in times else F.col(c).cast("double")).alias(c) for c in columns])
    numbers = numbers if written else cut(numbers)
    quartiles = exact_quantiles(numbers, columns, [0.25, 0.5, 0.75], written=True)
    stats = numbers.agg(*[
        f(c).alias(f"{c}__{name}")
        for c in columns
        for name, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ])
    rows = [
        (c, F.col(f"{c}__count"), F.col(f"{c}__mean"), F.col(f"{c}__std"), F.col(f"{c}__min"),
         *[F.lit(q).cast("double") for q in quartiles[c]], F.col(f"{c}__max"))
        for c in columns
    ]
    return stacked(stats, rows, ["column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"])


def overview(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 1000) -> DataFrame:
    """(column, dtype, rows, nulls, distinct, mean, std, smallest, largest, q25, q50, q75) of every column, in one aggregate.

    One pass without moving rows: tasks send one record each. ``distinct`` is a sketch, about 2 % off, and the
    quartiles are at most rows / ``accuracy`` ranks off; the rest is exact. Times are described as seconds since the
    epoch; text has no mean, deviation or quartiles. ``column_info`` and ``describe`` give the exact values.
    """
    columns = list(columns or df.columns)
    numeric, times, types = set(numeric_columns(df)), set(time_columns(df)), dict(df.dtypes)
    none = F.lit(None).cast("double")
    value = lambda c: F.col(c).cast("double") if c in numeric else epoch_seconds(c) if c in times else None
    sums, rows = [F.count("*").alias("_rows")], []
    for i, c in enumerate(columns):
        x = value(c)
        sums += [F.count_if(F.col(c).isNull()).alias(f"nulls{i}"), F.approx_count_distinct(c, 0.02).alias(f"distinct{i}"),
                 F.min(c).cast("string").alias(f"smallest{i}"), F.max(c).cast("string").alias(f"largest{i}")]
        if x is not None:
            sums += [F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                     F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"quartiles{i}")]
        of = lambda name: F.col(f"{name}{i}") if x is not None else none
        quartile = lambda k: F.col(f"quartiles{i}")[k] if x is not None else none
        rows.append((c, types[c], F.col("_rows"), F.col(f"nulls{i}"), F.col(f"distinct{i}"), of("mean"), of("std"),
                     F.col(f"smallest{i}"), F.col(f"largest{i}"), quartile(0), quartile(1), quartile(2)))
    names = ["column", "dtype", "rows", "nulls", "distinct", "mean", "std", "smallest", "largest", "q25", "q50", "q75"]
    return stacked(df.agg(*sums), rows, names)


def missing_table(df: DataFrame) -> DataFrame:
    """(column, missing, percent) for the columns with missing values."""
    return null_counts(df).where("missing > 0").select(
        "column", "missing", share(F.col("missing"), F.col("rows")).alias("percent")
    )


def category_counts(df: DataFrame, column: str, top_n: int | None = 10) -> DataFrame:
    """(value, n, percent): most frequent values; the share is of all non-null rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    shares = counts.withColumn("percent", share(F.col("n"), total)).orderBy(F.desc("n"), "value")
    return shares if top_n is None else shares.limit(top_n)


def top_values(df: DataFrame, k: int = 5) -> DataFrame:
    """(column, distinct_values, rank, value, n): most frequent values of every text column."""
    counts = value_counts(df, text_columns(df)).where(F.col("txt").isNotNull())
    # ``n`` is never 0; looked at, it stays in the counts, so that both uses share them.
    distinct = counts.groupBy("column").agg(F.count_if(F.col("n") > 0).alias("distinct_values"))
    return (
        top_per_group(counts, ["column"], [F.desc("n"), F.col("txt")], k)
        .join(distinct, "column")
        .select("column", "distinct_values", "rank", F.col("txt").alias("value"), "n")
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, lower, upper, n): equal-width bins, the last one closed; empty bins are kept."""
    x = F.col(column).cast("double")
    low, high = F.min(x), F.max(x)
    flat = low == high
    edges = df.agg(F.struct(
        F.when(flat, low - 0.5).otherwise(low).alias("low"), F.when(flat, high + 0.5).otherwise(high).alias("high")
    ).alias("edges")).scalar()
    place = F.floor((x - edges["low"]) * bins / (edges["high"] - edges["low"]))
    counts = (
        df.where(x.isNotNull())
        .select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    width = (edges["high"] - edges["low"]) / bins
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).where(edges["low"].isNotNull())
    return frame.join(counts, "bin", "left").select(
        "bin",
        (edges["low"] + F.col("bin") * width).alias("lower"),
        (edges["low"] + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(a, b, corr): Pearson correlation of every ordered pair over the rows where both are present."""
    columns = list(columns or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    upper = {(a, b): F.col(f"{a}__{b}") for a, b in pairs}
    rows = [(a, b, upper.get((a, b), upper.get((b, a)))) for a in columns for b in columns]
    return stacked(one, rows, ["a", "b", "corr"])


def sum_by(df: DataFrame, key: str, value: str = "sales") -> DataFrame:
    """Totals per key, largest first."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(f"total_{value}"))
        .orderBy(F.desc(f"total_{value}"), key)
    )


def monthly_totals(df: DataFrame, date_col: str = "order_date", value: str = "sales") -> DataFrame:
    """Totals per calendar month that occurs."""
    month = F.trunc(date_col, "month").alias("month")
    return (
        df.where(F.col(date_col).isNotNull())
        .groupBy(month)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(f"total_{value}"))
        .orderBy("month")
    )
