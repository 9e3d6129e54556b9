"""Exact quantiles of columns of any length.

``percentile`` keeps every distinct value of a group in one buffer. That is used only
while the columns have at most ``small`` values together. Longer columns are narrowed: a
sketch with a known rank error gives two fences around each wanted rank, an exact count tells
on which side of the fences the rank lies, and only the values between them are looked at
again, until they fit one buffer. No pass shuffles more than sketches and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.ordered import running_totals
from shelfwise.functions.storage import cut

SMALL = 100_000
RANK_ERROR = 1e-3


@dataclass(frozen=True)
class _Zone:
    """Values of a column strictly between two fences: ``size`` of them, ``start`` values are smaller."""

    column: str
    low: float | None
    high: float | None
    start: int
    size: int
    positions: tuple[float, ...]  # wanted places among all values of the column, from 0

    def holds(self) -> Column:
        value = F.col(self.column)
        inside = value.isNotNull()
        if self.low is not None:
            inside = inside & (value > self.low)
        if self.high is not None:
            inside = inside & (value < self.high)
        return inside


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    small: int = SMALL,
    rank_error: float = RANK_ERROR,
    written: bool = False,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the non-null values of each column.

    The long columns are passed over several times, so they are written first unless ``df`` reads a ``written`` table.
    """
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    if not columns:
        return {}
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    short = [c for c in columns if counts[c] * len(columns) <= small]
    result: dict[str, list[float | None]] = {}
    if short:
        wanted = F.array(*[F.lit(p) for p in probabilities])
        row = df.agg(*[F.percentile(c, wanted).alias(c) for c in short]).first()
        result.update({c: list(row[c] or [None] * len(probabilities)) for c in short})
    long = [c for c in columns if c not in short]
    if long:
        places = {c: [(counts[c] - 1) * p for p in probabilities] for c in long}
        zones = [_Zone(c, None, None, 0, counts[c], tuple(places[c])) for c in long]
        table = df.select(*long)
        found = _values_at(table if written else cut(table), zones, small, rank_error)
        for c in long:
            ends = [(found[c, floor(x)], found[c, ceil(x)], x - floor(x)) for x in places[c]]
            result[c] = [low + (high - low) * part for low, high, part in ends]
    return result


def _ranks(position: float) -> set[int]:
    return {floor(position), ceil(position)}


def _values_at(table: DataFrame, zones: list[_Zone], small: int, rank_error: float) -> dict[tuple[str, int], float]:
    """(column, rank) -> value for every wanted rank, all zones sharing each pass over the table."""
    found: dict[tuple[str, int], float] = {}
    while zones:
        near = [z for z in zones if z.size <= small]
        far = [z for z in zones if z.size > small]
        if near:
            found.update(_read_out(table, near))
        zones = _narrowed(table, far, rank_error, found) if far else []
        if any(z.size > small for z in zones):
            table = cut(table.where(reduce(Column.__or__, [z.holds() for z in zones])))
    return found


def _read_out(table: DataFrame, zones: list[_Zone]) -> dict[tuple[str, int], float]:
    """Values at the ranks of zones that are small enough to be sorted by one task each."""
    cells = [
        F.when(z.holds(), F.struct(F.lit(i).alias("zone"), F.col(z.column).alias("v"))) for i, z in enumerate(zones)
    ]
    window = Window.partitionBy("zone").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        table.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("zone", "v").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(window))
    )
    wanted = [(i, z.column, r, r - z.start) for i, z in enumerate(zones) for p in z.positions for r in _ranks(p)]
    wanted = [w for w in dict.fromkeys(wanted) if 0 <= w[3] < zones[w[0]].size]
    row = placed.agg(*[
        F.min(F.when((F.col("zone") == i) & (F.col("upto") > inner), F.col("v"))) for i, _, _, inner in wanted
    ]).first()
    return {(column, rank): row[k] for k, (_, column, rank, _) in enumerate(wanted)}


def _narrowed(table: DataFrame, zones: list[_Zone], rank_error: float, found: dict) -> list[_Zone]:
    """The zones split at fences around each wanted rank; ranks that hit a fence go to ``found``."""
    names = [f"z{i}" for i in range(len(zones))]
    parts = table.select(*[F.when(z.holds(), F.col(z.column)).alias(n) for n, z in zip(names, zones)])
    wanted = [(i, p, (p - z.start) / z.size) for i, z in enumerate(zones) for p in z.positions]
    points = sorted({min(1.0, max(0.0, share + d * 2 * rank_error)) for _, _, share in wanted for d in (-1, 1)})
    sketches = parts.approxQuantile(names, points, rank_error)
    fences = []
    for i, _, share in wanted:
        low, high = (points.index(min(1.0, max(0.0, share + d * 2 * rank_error))) for d in (-1, 1))
        fences.append((sketches[i][low], sketches[i][high]))
    row = parts.agg(*[
        F.count_if(test) for (i, _, _), (low, high) in zip(wanted, fences)
        for v in [F.col(names[i])] for test in (v < low, v <= low, v < high, v <= high)
    ]).first()
    split: dict[tuple, set[float]] = {}
    for k, ((i, position, _), (low, high)) in enumerate(zip(wanted, fences)):
        zone = zones[i]
        below_low, upto_low, below_high, upto_high = row[4 * k : 4 * k + 4]
        for rank in _ranks(position):
            inner = rank - zone.start
            if inner < 0 or inner >= zone.size or (zone.column, rank) in found:
                continue
            if inner < below_low:
                part = (zone.low, low, zone.start, below_low)
            elif inner < upto_low:
                found[zone.column, rank] = low
                continue
            elif inner < below_high:
                part = (low, high, zone.start + upto_low, below_high - upto_low)
            elif inner < upto_high:
                found[zone.column, rank] = high
                continue
            else:
                part = (high, zone.high, zone.start + upto_high, zone.size - upto_high)
            split.setdefault((zone.column, *part), set()).add(position)
    return [_Zone(*part, tuple(sorted(positions))) for part, positions in split.items()]


def bin_by_edges(value: Column, edges: Sequence[float]) -> Column:
    """1-based bin of a value among ascending edges: right-closed, lowest included."""
    distinct = sorted(set(edges))
    steps = [F.when(value > F.lit(e), 1).otherwise(0) for e in distinct[1:-1]]
    code = F.lit(1)
    for step in steps:
        code = code + step
    return F.when(value.isNotNull(), code)


def grouped_medians(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """(*by, name): exact median per group, by counting values, so a group never sits in one buffer."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("_v")).agg(
        F.count("*").alias("_n")
    )
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    placed = running_totals(counts, by, ["_v"], {"_upto": F.col("_n")}).join(totals, list(by))
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_v")))
    last = F.col("_total") - 1
    return placed.groupBy(*by).agg(((at(F.floor(last / 2)) + at(F.ceil(last / 2))) / 2).alias(name))
