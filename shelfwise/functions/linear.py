"""Least squares for many groups at once, from one small Gram matrix per group.

A matrix of size n is an array of n * n doubles, row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# A pivot below this share of the first diagonal entry counts as zero: its variable adds nothing.
LEAST_PIVOT = 1e-12


def entry(matrix: Column, size: int, i: Column | int, j: Column | int) -> Column:
    """Entry (i, j), from 0."""
    at = (F.lit(i) if isinstance(i, int) else i) * size + j + 1
    return F.element_at(matrix, at.cast("int"))


def gram(values: Sequence[str]) -> Column:
    """Aggregate: the matrix of sums of products of the expressions, given as SQL; equal sums are made once."""
    return F.expr(f"array({', '.join(f'sum(({min(a, b)}) * ({max(a, b)}))' for a in values for b in values)})")


def swept(matrix: Column, size: int, pivots: Column) -> Column:
    """The matrix after Gauss-Jordan sweeps on the variables in the array ``pivots`` (from 0).

    Then entry (k, y) of a pivot k and another variable y is the coefficient of k in the regression of y on all
    pivots, and entry (y, y) the sum of squares left. Pivots that depend on those before are left
    out: their rows and columns become 0.
    """
    least = LEAST_PIVOT * F.element_at(matrix, 1)

    def sweep(m: Column, k: Column) -> Column:
        pivot = entry(m, size, k, k)

        def cell(v: Column, at: Column) -> Column:
            i, j = F.floor(at / size), at % size
            return (
                F.when(pivot <= least, F.when((i == k) | (j == k), 0.0).otherwise(v))
                .when((i == k) & (j == k), 1 / pivot)
                .when(i == k, v / pivot)
                .when(j == k, -v / pivot)
                .otherwise(v - entry(m, size, i, k) * entry(m, size, k, j) / pivot)
            )

        return F.transform(m, cell)

    return F.aggregate(pivots, matrix, sweep)


def transformed(matrix: str, size: int, rows: Sequence[dict[int, str]]) -> Column:
    """The Gram matrix of linear combinations of the variables of a named matrix.

    ``rows`` has, for each new variable, the weights other than 0 of the old ones as SQL.
    """
    def product(a, b):
        return " + ".join(f"({v}) * ({w}) * {matrix}[{i * size + j}]" for i, v in a.items() for j, w in b.items())

    return F.expr(f"array({', '.join(product(a, b) for a in rows for b in rows)})")
