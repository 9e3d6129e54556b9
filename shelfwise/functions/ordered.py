"""Row numbers, running totals and trailing windows that survive oversized groups.

A plain window puts a whole group into one task. Groups of at most ``hot_rows`` rows, which are
counted first, go that way; only the rows of larger groups are range-partitioned on (group, order), so
that one group spreads over many slices. Each slice is numbered on its own and shifted by the totals
of the slices before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from shelfwise.functions.storage import cut

HOT_ROWS = 2_000_000
MAX_SLICES = 20_000  # windows over slices run in order and spill, so larger slices cost time, not memory
MAX_BROADCAST_KEYS = 100_000


def _split(df: DataFrame, by: Sequence[str], hot_rows: int) -> tuple[DataFrame | None, DataFrame | None, int]:
    """(rows of groups that fit one task, rows of larger ones, how many these are); None for a part without rows."""
    if not by:
        n = df.count()
        return (df, None, 0) if n <= hot_rows else (None, df, n)
    sizes = df.groupBy(*by).count()
    large = F.count_if(F.col("count") > hot_rows)
    row = sizes.agg(F.sum("count"), F.sum(F.when(F.col("count") > hot_rows, F.col("count"))), large).first()
    rows, hot, keys = row[0] or 0, row[1] or 0, row[2]
    if not hot:
        return df, None, 0
    if hot == rows:
        return None, df, hot
    held = [f"_hot_{i}" for i in range(len(by))]
    names = cut(sizes.where(F.col("count") > hot_rows).select(*[F.col(c).alias(h) for c, h in zip(by, held)], F.lit(True).alias("_hot")))
    names = F.broadcast(names) if keys <= MAX_BROADCAST_KEYS else names
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(h)) for c, h in zip(by, held)])
    marked = cut(df.join(names, same, "left").drop(*held))
    return marked.where("_hot IS NULL").drop("_hot"), marked.where("_hot").drop("_hot"), hot


def _both(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    return hot if cold is None else cold if hot is None else cold.unionByName(hot)


def _slices(rows: int, size: int) -> int:
    return max(1, min(MAX_SLICES, ceil(rows / max(size, 1))))


def _sliced_totals(df: DataFrame, rows: int, by: list[str], order: list[str | Column], totals: dict[str, Column], hot_rows: int) -> DataFrame:
    """Running totals over slices of (group, order)."""
    ranged = cut(
        df.withColumns({f"_add_{name}": value for name, value in totals.items()})
        .repartitionByRange(_slices(rows, hot_rows // 4), *by, *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*by, "_slice")
        .agg(*[F.sum(f"_add_{name}").alias(f"_sub_{name}") for name in totals])
        .withColumns({f"_shift_{name}": F.coalesce(F.sum(f"_sub_{name}").over(before), F.lit(0)) for name in totals})
        .select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_slice").alias("_of"), *[f"_shift_{name}" for name in totals])
    )
    same = [F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)]  # a null key is a group too
    window = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(shifts, reduce(Column.__and__, same, F.col("_slice") == F.col("_of")))
        .withColumns({name: F.sum(f"_add_{name}").over(window) + F.col(f"_shift_{name}") for name in totals})
        .select(*df.columns, *totals)
    )


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    totals: dict[str, Column],
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds inclusive running sums of ``totals`` inside each group, in the given total order."""
    by, order = list(by), list(order)
    cold, hot, rows = _split(df, by, hot_rows)
    if cold is not None:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        cold = cold.withColumns({name: F.sum(value).over(window) for name, value in totals.items()})
    if hot is not None:
        hot = _sliced_totals(hot, rows, by, order, totals, hot_rows)
    return _both(cold, hot)


def row_numbers(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """1-based position of each row in its group; ``order`` must be a total order."""
    return running_totals(df, by, order, {name: F.lit(1).cast("long")}, hot_rows=hot_rows)


def trailing(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    reach: int,
    expressions: Callable[[WindowSpec], dict[str, Column]],
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Window expressions that look back at most ``reach`` rows inside each group.

    Oversized groups are cut into chunks of consecutive positions. The last ``reach`` rows
    of a chunk are also sent to the next one, where they serve as history and are dropped.
    """
    by, order = list(by), list(order)
    cold, hot, rows = _split(df, by, hot_rows)
    if cold is not None:
        cold = cold.withColumns(expressions(Window.partitionBy(*by).orderBy(*order)))
    if hot is not None:
        size = max(hot_rows // 4, reach + 1)
        at = F.col("_position") - 1
        home = F.floor(at / size)
        numbered = _sliced_totals(hot, rows, by, order, {"_position": F.lit(1).cast("long")}, hot_rows)
        chunked = numbered.withColumn("_home", home).withColumn(
            "_chunk", F.explode(F.array_distinct(F.array(home, F.floor((at + reach) / size)))))
        window = Window.partitionBy(*by, "_chunk").orderBy("_position")
        hot = (
            chunked.withColumns(expressions(window))
            .where(F.col("_chunk") == F.col("_home"))
            .drop("_position", "_home", "_chunk")
        )
    return _both(cold, hot)
