"""Small reshaping helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def whole_columns(df: DataFrame) -> list[str]:
    """Columns of whole numbers that a long holds exactly."""
    def exact(kind: T.DataType) -> bool:
        return isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18)

    return [f.name for f in df.schema.fields if exact(f.dataType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def time_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]


def stacked(one_row: DataFrame, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """Turns a one-row frame into one row per entry of ``rows``; cells are columns or literals."""
    def cell(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    structs = [F.struct(*[cell(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, whole, num, txt, n): how often each value of each column occurs, nulls included.

    Whole numbers are held in ``whole``, other numbers in ``num``; text, and times as ISO text, in
    ``txt``. Counts are combined on the map side, so a value holding most rows costs one record per task.
    """
    numbers, whole = set(numeric_columns(df)), set(whole_columns(df))

    def cell(name: str, kind: str, held: bool) -> Column:
        return F.col(name).cast(kind) if held else F.lit(None).cast(kind)

    cells = [
        F.struct(
            F.lit(c).alias("column"),
            cell(c, "long", c in whole).alias("whole"),
            cell(c, "double", c in numbers - whole).alias("num"),
            cell(c, "string", c not in numbers).alias("txt"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*cells))).groupBy("column", "whole", "num", "txt").agg(F.count("*").alias("n"))


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group. Spark keeps only ``k`` rows per group and task before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


# More values than this cannot sensibly become columns of one table; the long forms have no such bound.
MAX_COLUMNS = 5000


def column_values(df: DataFrame, column: str) -> list:
    """Distinct non-null values in order, read by the driver because they become the schema.

    For columns with more values use the long forms ``encode.onehot_flags``, ``basket.transaction_items``
    and ``metrics.confusion_counts``.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(MAX_COLUMNS + 1).collect()
    if len(values) > MAX_COLUMNS:
        raise ValueError(f"{column} has more than {MAX_COLUMNS} values, too many to become columns; use the long form")
    return [r[0] for r in values]


def share(part: Column, whole: Column) -> Column:
    return part * 100.0 / whole


def epoch_seconds(name: str) -> Column:
    """Seconds since 1970-01-01 by the clock the column shows, whatever the session time zone."""
    days = F.date_diff(F.to_date(name), F.lit("1970-01-01").cast("date"))
    minutes = days.cast("double") * 1440 + F.hour(name) * 60 + F.minute(name)
    return minutes * 60 + F.extract(F.lit("SECOND"), F.col(name)).cast("double")
