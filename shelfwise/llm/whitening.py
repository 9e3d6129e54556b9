"""Whitening of embeddings, with the leading eigenvectors of their covariance by spectrum slicing.

Vectors are whole numbers (fixed point), so sums, centred products and distances are exact whatever the order
in which tasks add them. The covariance, of the size of the dimension squared, is sliced on the driver:
the signs of the pivots of an LDL' factorisation of V - s I tell how many eigenvalues lie above s (inertia);
bisection by these counts isolates each leading eigenvalue in an interval of its own; Rayleigh quotient iteration
from there converges cubically; and two more counts, just below and above the value found, certify its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.arrow import table

BOUND = 1 << 41  # of an entry's size; far beyond any embedding, it keeps sums of products within 38 digits
_EPS = float(np.finfo(float).eps)
_APART = 1e-11  # eigenvalues closer than this share of the norm form a cluster; smaller ones count as zero
_TRIES = 60


def fixed_point(vectors: DataFrame, vector: str, scale: int = 64, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift for each entry c of a column of vectors; null for vectors to leave out.

    Left out are null vectors and those with an entry that is null, not finite, or beyond 2**40 once scaled.
    """
    entries = vectors[vector].cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale <= BOUND // 2))
    return F.when(usable, F.transform(entries, lambda c: F.floor(c * scale).cast("long") + shift))


# --- the spectrum of a symmetric matrix ---

def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than the shift: positive pivots of LDL' with pivots of order one and two."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive, alpha = len(a), 0, 0, (1 + 17**0.5) / 8

    def swap(i, j):
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        largest = below.max(initial=0.0)
        if largest == 0:  # this row stands alone
            positive += a[k, k] > 0
            k += 1
            continue
        r, order = k + 1 + int(below.argmax()), 1
        if abs(a[k, k]) < alpha * largest:
            across = np.abs(a[r, k:])
            across[r - k] = 0
            if abs(a[k, k]) * across.max() < alpha * largest**2:
                if abs(a[r, r]) >= alpha * across.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    order = 2
        head, tail = a[k : k + order, k : k + order], a[k + order :, k : k + order]
        if order == 1:
            positive += head[0, 0] > 0
            a[k + 1 :, k + 1 :] -= np.outer(tail[:, 0], tail[:, 0] / head[0, 0])
        else:
            positive += 1  # such a pivot has one eigenvalue of either sign
            a[k + 2 :, k + 2 :] -= tail @ np.linalg.solve(head, tail.T)
        k += order
    return int(positive)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, norm: float) -> np.ndarray:
    """(matrix - shift I) x = right, with the shift moved off an eigenvalue that it hits."""
    while True:
        try:
            found = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(found).all():
                return found
        except np.linalg.LinAlgError:
            pass
        shift += 4 * _EPS * norm


def _rayleigh(matrix: np.ndarray, low: float, high: float, norm: float) -> tuple[float, np.ndarray, float] | None:
    """(eigenvalue, vector, residual) by Rayleigh quotient iteration from an interval; None when it leaves that."""
    x = np.random.default_rng(len(matrix)).standard_normal(len(matrix))
    shift, best = (low + high) / 2, None
    for turn in range(_TRIES):
        x = _solve(matrix, shift, x / np.linalg.norm(x), norm)
        x /= np.linalg.norm(x)
        ahead = matrix @ x
        value = float(x @ ahead)
        residual = float(np.linalg.norm(ahead - value * x))
        if best is None or residual < best[2]:
            best = value, x, residual
        elif residual <= 64 * _EPS * norm:
            break  # as good as the arithmetic allows
        if turn >= 1:
            shift = value  # after two steps at the middle of the interval
    return best if low < best[0] < high and best[2] <= 64 * _EPS * norm * len(matrix) ** 0.5 else None


def _jacobi(matrix: np.ndarray) -> np.ndarray:
    """Rotation that makes a small symmetric matrix diagonal."""
    a, turn = matrix.copy(), np.eye(len(matrix))
    for _ in range(_TRIES):
        if np.abs(a - np.diag(np.diag(a))).max(initial=0.0) <= _EPS * np.abs(a).max(initial=0.0):
            break
        for p in range(len(a)):
            for q in range(p + 1, len(a)):
                if a[p, q] != 0:
                    angle = 0.5 * np.arctan2(2 * a[p, q], a[q, q] - a[p, p])
                    c, s = np.cos(angle), np.sin(angle)
                    spin = np.eye(len(a))
                    spin[[p, q], [p, q]], spin[p, q], spin[q, p] = c, s, -s
                    a, turn = spin.T @ a @ spin, turn @ spin
    return turn


def _cluster(matrix: np.ndarray, low: float, high: float, size: int, norm: float) -> list[tuple[float, np.ndarray]]:
    """Eigenvalues too close to be told apart, falling: an orthonormal basis of their space, made diagonal in it."""
    x = np.random.default_rng(size).standard_normal((len(matrix), size))
    for _ in range(6):
        x = np.linalg.qr(_solve(matrix, (low + high) / 2, x, norm))[0]
    x = x @ _jacobi(x.T @ matrix @ x)
    values = np.einsum("ij,ij->j", x, matrix @ x)
    return [(float(values[i]), x[:, i]) for i in np.argsort(-values)]


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the largest eigenvalues of a positive semidefinite matrix, falling.

    Fewer than ``most`` come back where the others are below 1e-11 of the norm, which counts as zero. Equal values have
    any orthonormal basis of their space.
    """
    norm = float(np.linalg.norm(matrix))
    found: dict[int, tuple[float, np.ndarray]] = {}
    apart = _APART * norm
    if norm == 0:
        return np.empty(0), np.empty((len(matrix), 0))
    most = min(most, above(matrix, apart))
    # Intervals with the numbers of eigenvalues above either end; those left are always the lower ones.
    slices = [(apart, 1.01 * norm, above(matrix, apart), 0)]
    while slices:
        low, high, upto, over = slices.pop()
        if over >= min(upto, most):
            continue
        if upto - over == 1 and (one := _rayleigh(matrix, low, high, norm)):
            value, vector, residual = one
            margin = 4 * residual + 16 * _EPS * norm
            if above(matrix, value + margin) == over and above(matrix, value - margin) == upto:
                found[upto] = value, vector
                continue
        if high - low <= apart:
            for i, pair in enumerate(_cluster(matrix, low, high, upto - over, norm)):
                found[over + 1 + i] = pair
            continue
        middle = (low + high) / 2
        between = above(matrix, middle)
        slices += [(low, middle, upto, between), (middle, high, between, over)]
    chosen = [found[i] for i in range(1, most + 1)]
    if not chosen:
        return np.empty(0), np.empty((len(matrix), 0))
    vectors = np.stack([v for _, v in chosen], axis=1)
    basis, turn = np.linalg.qr(vectors)  # neighbours are orthogonal only as far as their gap allows
    return np.array([v for v, _ in chosen]), basis * np.sign(np.diag(turn))


# --- sums over the rows ---

def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, all of one length and without nulls, as rows of whole numbers."""
    entries = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return entries.reshape(batch.num_rows, -1).astype(np.int64, copy=False)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left' right, exactly, as Python numbers."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(len(left), 1)
    if most < 1 << 53:
        return (left.T.astype(float) @ right.astype(float)).astype(np.int64).astype(object)
    return (left.T @ right).astype(object) if most < 1 << 62 else left.T.astype(object) @ right.astype(object)


def _summed(vectors: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int, exact: bool = True) -> list:
    """Sum over all rows of the array that ``of`` makes from the matrix of a batch: one partial array from each task."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object if exact else float)
        for batch in batches:
            if batch.num_rows:
                total = total + of(_matrix(batch))
        held = pa.array([Decimal(v) for v in total.tolist()], pa.decimal128(38, 0)) if exact else pa.array(total)
        yield table(cell=np.arange(size), total=held)

    cells = vectors.mapInArrow(partial, f"cell long, total {'decimal(38, 0)' if exact else 'double'}")
    held = {r["cell"]: r["total"] for r in cells.groupBy("cell").agg(F.sum("total").alias("total")).collect()}
    return [int(held.get(i, 0)) if exact else held.get(i, 0.0) for i in range(size)]


@dataclass
class Whitening:
    """What tasks need to whiten a row, and what was measured; all of it is of the size of the dimension squared."""

    n: int
    centre: np.ndarray  # whole numbers next to the means
    rest: list[int]  # n times mean less n times centre, exactly
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dimensions(self) -> int:
        return len(self.centre)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        offset = np.array([r / self.n for r in self.rest])
        return ((x - self.centre) - offset) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)**2 for each row, exactly, as n**2 y.y - 2 n y.r + r.r with y = x - centre."""
        y, most = x - self.centre, max(map(abs, self.rest), default=0)
        size = int(np.abs(y).max(initial=0)) * self.dimensions
        whole = y if size * max(size, most) < 1 << 62 else y.astype(object)
        squares, mixed = (whole * whole).sum(axis=1), whole @ np.array(self.rest, dtype=whole.dtype)
        own = sum(r * r for r in self.rest)
        return [self.n * self.n * a - 2 * self.n * b + own for a, b in zip(squares.tolist(), mixed.tolist())]


def _usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part, but for the length of their vectors."""
    picked = rows.select(rows[id].cast("long").alias("id"), rows[vector].cast("array<bigint>").alias("vector"))
    return picked.where(F.forall("vector", lambda c: c.isNotNull() & c.between(-BOUND, BOUND)))


def _dimensions(vectors: DataFrame) -> tuple[int, int]:
    """The most frequent length, the longer one among ties, and how many vectors have it."""
    row = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (row["d"], row["count"]) if row else (0, 0)


def fit(rows: DataFrame, most: int = 32, id: str = "vec_id", vector: str = "vector") -> Whitening:
    """Components of the covariance (divisor n) of a column of whole-number vectors, numbered by falling eigenvalue.

    Vectors that are null, hold nulls or entries beyond 2**41, or have another length than most vectors (the longer among
    ties) take no part, here or in ``whiten``. Equal vectors, repeated and null ids are rows like others.
    Directions in which the vectors do not vary give no component, so constant vectors, single rows
    and empty tables have none. The driver holds a few matrices of the dimension squared.
    """
    vectors = _usable(rows, id, vector)
    d, n = _dimensions(vectors)
    if not d:
        return Whitening(0, np.empty(0, np.int64), [], np.empty(0), np.empty((0, 0)), 0.0)
    vectors = vectors.where(F.size("vector") == d).select("vector")
    sums = _summed(vectors, lambda x: x.sum(axis=0).astype(object), d)
    centre = np.array([round(s / n) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    upper = np.triu_indices(d)
    products = _summed(vectors, lambda x: _products(x - centre, x - centre)[upper], len(upper[0]))
    covariance = np.zeros((d, d))
    for i, j, total in zip(*map(np.ndarray.tolist, upper), products):
        covariance[i, j] = covariance[j, i] = (n * total - rest[i] * rest[j]) / (n * n)
    values, components = leading(covariance, most)
    model = Whitening(n, centre, rest, values, components, float(np.trace(covariance)))
    k = len(values)
    if k:  # measured on the whitened rows themselves, which have mean zero
        inner = np.triu_indices(k)

        def moments(x):
            w = model.whitened(x)
            return np.concatenate([(w.T @ w)[inner], w.sum(axis=0)])

        held = np.array(_summed(vectors, moments, len(inner[0]) + k, exact=False)) / n
        mean = held[len(inner[0]) :]
        model.identity_error = float(np.abs(held[: len(inner[0])] - mean[inner[0]] * mean[inner[1]] - (inner[0] == inner[1])).max())
    return model


def whiten(rows: DataFrame, model: Whitening, id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(vec_id, deviation, whitened) of each row that took part in the fit, as ``fit`` says; other columns are ignored.

    ``whitened`` has one number for each component, ``deviation`` is the sum over the dimensions of (n x - S)**2 for
    the sums S of n vectors, exact, as decimal(38, 0).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                w = model.whitened(x)
                ends = np.arange(0, w.size + 1, max(w.shape[1], 1), dtype=np.int32) if w.shape[1] else np.zeros(len(w) + 1, np.int32)
                yield table(vec_id=batch.column("id"),
                            deviation=pa.array([Decimal(v) for v in model.deviations(x)], pa.decimal128(38, 0)),
                            whitened=pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel())))

    vectors = _usable(rows, id, vector)
    return vectors.where(F.size("vector") == model.dimensions).where(F.lit(model.dimensions > 0)).mapInArrow(
        run, "vec_id long, deviation decimal(38, 0), whitened array<double>")
