"""Value counts, modes and lookup joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.shape import value_counts
from shelfwise.functions.storage import cut

# A lookup table is broadcast only after it was measured to be below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, int | float | str | None]:
    """Most frequent value of each column, the smallest among ties; absent when all are null."""
    held = ("whole", "num", "txt")
    present = value_counts(df, columns).where(F.coalesce(*[F.col(c).cast("string") for c in held]).isNotNull())
    best = F.min_by(F.struct(*held), F.struct(-F.col("n"), *[F.col(c) for c in held]))
    rows = present.groupBy("column").agg(best.alias("best")).collect()
    return {r["column"]: next(v for v in r["best"] if v is not None) for r in rows}


def left_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``; the lookup side, written once, is broadcast when measured small, shuffled otherwise."""
    lookup = cut(lookup)
    row_bytes = F.octet_length(F.to_json(F.struct(*lookup.columns)))
    size = lookup.agg(F.count("*").alias("n"), F.sum(row_bytes).alias("b")).first()
    if size["n"] <= BROADCAST_ROWS and (size["b"] or 0) <= BROADCAST_BYTES:
        lookup = F.broadcast(lookup)
    return df.join(lookup, key, "left")
