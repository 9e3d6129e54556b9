"""k-means with all starts, for one or several numbers of clusters, side by side.

The points are packed once into leaves: up to ``LEAF`` points close to each other, flat in one array per row. A round
is one Spark job for all runs whose centres still move: a task holds the bounding boxes of leaves against the centres,
leaves out those that cannot be nearest to any point of a leaf, and returns sums and sizes per centre. Only leaves between
centres are looked at point by point. The starts of all runs are drawn side by side in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.storage import cut

LEAF = 512
CHUNK = 1 << 17  # so many rows of a task are split into leaves at a time
TASK_ROWS = 20_000  # fewer points than this are one task
PAIRS = 1 << 20  # pairs of leaves and centres that a task looks at together
DRAWS, START_ROUNDS = 2, 30  # steps of k-means||, and rounds of k-means on the points it draws


def leaves(points: np.ndarray):
    """Points split at the median of their widest feature until at most ``LEAF`` are left together."""
    todo = [points]
    while todo:
        some = todo.pop()
        if len(some) <= LEAF:
            yield some
        else:
            half = len(some) // 2
            some = some[np.argpartition(some[:, np.ptp(some, axis=0).argmax()], half)]
            todo += [some[half:], some[:half]]


def pack(batches):
    """Arrow batches of points to batches of leaves."""
    def flush(held):
        parts = [part.ravel() for part in leaves(np.concatenate(held)) if len(part)]
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.list_(pa.float64()))], ["xs"])

    held, n = [], 0
    for batch in batches:
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        n += len(held[-1])
        if n >= CHUNK:
            yield flush(held)
            held, n = [], 0
    if n:
        yield flush(held)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The place of each point's nearest centre; distances are taken from the first centre, to keep their digits."""
    from_first = centres - centres[0]
    return ((from_first**2).sum(1) - 2 * (points - centres[0]) @ from_first.T).argmin(1)


def groups(batches, width: int, centres: int):
    """(points of each leaf, low, high, sums, sizes, scatter around the mean), of so many leaves that their pairs with centres fit in memory."""
    for whole in batches:
        step = max(1, PAIRS // max(1, centres))
        for batch in (whole.slice(i, step) for i in range(0, whole.num_rows, step)):
            held = batch.column(0)
            points, sizes = held.flatten().to_numpy().reshape(-1, width), held.value_lengths().to_numpy() // width
            at = np.cumsum(sizes) - sizes
            low, high, sums = (f.reduceat(points, at) for f in (np.minimum, np.maximum, np.add))
            scatter = np.add.reduceat(((points - np.repeat(sums / sizes[:, None], sizes, axis=0)) ** 2).sum(1), at)
            yield np.split(points, at[1:]), low, high, sums, sizes, scatter


def may_be_nearest(low: np.ndarray, high: np.ndarray, runs: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Per run, leaf by centre, whether the centre can be the nearest of the run to any point in the leaf's box."""
    centres, first = np.concatenate(runs), np.cumsum([0, *map(len, runs[:-1])])
    closest, farthest = np.zeros((len(low), len(centres))), np.zeros((len(low), len(centres)))
    for f in range(low.shape[1]):
        below, above = low[:, f, None] - centres[:, f], centres[:, f] - high[:, f, None]
        closest += np.maximum(np.maximum(below, above), 0) ** 2
        farthest += np.maximum(np.abs(below), np.abs(above)) ** 2
    bound = np.minimum.reduceat(farthest, first, axis=1) * (1 + 1e-9)
    return np.split(closest <= np.repeat(bound, [len(own) for own in runs], axis=1), first[1:], axis=1)


def one_round(packed: DataFrame, runs: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """(per run an array of sums and size of each centre's points, cost of each run) for the given centres.

    A leaf near one centre only adds its sums, without a look at its points.
    """
    first, width = np.cumsum([0, *map(len, runs[:-1])]), runs[0].shape[1]

    def measure(batches):
        out, costs = [np.zeros((len(c), width + 1)) for c in runs], np.zeros(len(runs))
        for parts, low, high, whole, sizes, scatter in groups(batches, width, sum(map(len, runs))):
            for r, kept in enumerate(may_be_nearest(low, high, runs)):
                own, single = runs[r], kept.sum(1) == 1
                at, n = kept[single].argmax(1), sizes[single, None]
                for f, column in enumerate(np.column_stack([whole[single], n]).T):
                    out[r][:, f] += np.bincount(at, column, len(own))
                costs[r] += scatter[single].sum() + (n * (whole[single] / n - own[at]) ** 2).sum()
                for i in np.flatnonzero(~single):
                    points, at = parts[i], np.flatnonzero(kept[i])
                    found = at[nearest(points, own[at])]
                    for f in range(width):
                        out[r][:, f] += np.bincount(found, points[:, f], len(own))
                    out[r][:, width] += np.bincount(found, minlength=len(own))
                    costs[r] += ((points - own[found]) ** 2).sum()
        found = [np.concatenate(out).tobytes()], [costs.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in found], ["sums", "costs"])

    sums, costs = np.zeros((sum(map(len, runs)), width + 1)), np.zeros(len(runs))
    for row in packed.mapInArrow(measure, "sums binary, costs binary").collect():  # per task one row per centre
        sums += np.frombuffer(row["sums"]).reshape(sums.shape)
        costs += np.frombuffer(row["costs"])
    return np.split(sums, first[1:]), costs


def draw(packed: DataFrame, runs: Sequence[np.ndarray], counts: Sequence[int], width: int, seed: Sequence[int]) -> list[np.ndarray]:
    """Per run ``counts[r]`` points: chances go by the squared distance from the run's centres, and are equal while it has none.

    Every point of every leaf takes part: it gets an exponential variate over its weight, and the smallest ones win.
    """
    def race(batches):
        won = [np.empty((0, width + 1)) for _ in runs]
        limit = [np.inf] * len(runs)
        done = 0
        for parts, low, high, *_ in groups(batches, width, sum(map(len, runs))):
            kept = may_be_nearest(low, high, runs) if len(runs[0]) else None
            done += len(parts)
            for i, points in enumerate(parts):
                random = np.random.default_rng([*seed, done - i, crc32(points.tobytes())])
                for r, own in enumerate(runs):
                    times = random.standard_exponential(len(points))
                    if kept is not None:
                        near = own[np.flatnonzero(kept[r][i])]
                        weight = ((points - near[nearest(points, near)]) ** 2).sum(1)
                        times = np.divide(times, weight, out=np.full(len(points), np.inf), where=weight > 0)
                    fast = np.flatnonzero(times < limit[r])
                    if len(fast):
                        won[r] = np.concatenate([won[r], np.column_stack([times[fast], points[fast]])])
                    if len(won[r]) > counts[r]:
                        won[r] = won[r][np.argpartition(won[r][:, 0], counts[r] - 1)[: counts[r]]]
                        limit[r] = won[r][:, 0].max()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(runs)), pa.int32()), pa.array([w.tobytes() for w in won], pa.binary())], ["run", "won"])

    met = [[] for _ in runs]
    for row in packed.mapInArrow(race, "run int, won binary").collect():  # per task at most counts[r] points of a run
        met[row["run"]].append(np.frombuffer(row["won"]).reshape(-1, width + 1))
    found = [np.concatenate(parts) for parts in met]
    return [w[np.lexsort(w.T[::-1])[:n], 1:] for w, n in zip(found, counts)]


def reduced(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """At most k centres of a few weighted points, by k-means++ and rounds of k-means."""
    if len(points) <= k:
        return points
    centres, gaps = points[[random.choice(len(points), p=weights / weights.sum())]], np.full(len(points), np.inf)
    while len(centres) < k:
        gaps = np.minimum(gaps, ((points - centres[-1]) ** 2).sum(1))
        chance = gaps * weights
        if not chance.sum():
            break
        centres = np.append(centres, points[[random.choice(len(points), p=chance / chance.sum())]], axis=0)
    for _ in range(START_ROUNDS):
        found = nearest(points, centres)
        size = np.bincount(found, weights, len(centres))
        sums = np.column_stack([np.bincount(found, weights * points[:, f], len(centres)) for f in range(points.shape[1])])
        before, held = centres, size[:, None] > 0
        centres = np.where(held, sums / np.where(held, size[:, None], 1), before)
        if (centres == before).all():
            break
    return centres


def starts(packed: DataFrame, jobs: Sequence[tuple[int, int]], width: int, seed: int) -> list[np.ndarray]:
    """The first centres of each (k, number) by k-means||, all side by side in one job a step."""
    runs = [np.empty((0, width)) for _ in jobs]
    for step in range(DRAWS + 1):
        drawn = draw(packed, runs, [2 * k if step else 1 for k, _ in jobs], width, [seed, step])
        runs = [np.unique(np.concatenate(pair), axis=0) for pair in zip(runs, drawn)]
    sums, _ = one_round(packed, runs)
    return [reduced(own, total[:, -1], k, np.random.default_rng([seed, k, i])) for own, total, (k, i) in zip(runs, sums, jobs)]


def fit_many(
    df: DataFrame, features: Sequence[str], ks: Sequence[int], *, n_init: int = 10, max_iter: int = 300, seed: int = 42
) -> dict[int, tuple[np.ndarray, float]]:
    """k -> (centres in order, inertia) of the best of ``n_init`` runs.

    A run stops when the centres' squared shifts are below 1e-4 of the mean feature variance. Starts are drawn by
    k-means||; a centre without points stays. Features must not be null, NaN or infinite.
    """
    features = list(features)
    points = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    finite = [F.coalesce(F.abs(f) < float("inf"), F.lit(False)) for f in features]
    first = points.agg(F.count("*"), F.count_if(~reduce(Column.__and__, finite)), *[F.var_pop(f) for f in features]).first()
    if not first[0] or first[1]:
        raise ValueError(f"k-means needs points with finite features; {first[1]} of {first[0]} have others")
    spread = max(sum(first[2:]) / len(features), 1e-12)
    tasks = max(1, min(df.sparkSession.sparkContext.defaultParallelism, ceil(first[0] / TASK_ROWS)))
    packed = cut(points.repartition(tasks).mapInArrow(pack, "xs array<double>"))
    jobs = [(k, i) for k in ks for i in range(n_init)]
    runs = starts(packed, jobs, len(features), seed)

    moving = list(range(len(runs)))
    for _ in range(max_iter):
        sums, _ = one_round(packed, [runs[r] for r in moving])
        still = []
        for r, total in zip(moving, sums):
            before, held = runs[r], total[:, -1:] > 0
            runs[r] = np.where(held, total[:, :-1] / np.where(held, total[:, -1:], 1), before)
            if ((runs[r] - before) ** 2).sum(1).max() > 1e-4 * spread / jobs[r][0]:
                still.append(r)
        moving = still
        if not moving:
            break
    _, costs = one_round(packed, runs)
    best = {k: min((r for r, job in enumerate(jobs) if job[0] == k), key=lambda r: costs[r]) for k in ks}
    return {k: (np.unique(runs[r], axis=0), float(costs[r])) for k, r in best.items()}


def cluster_of(features: Sequence[str], centres: np.ndarray) -> Column:
    """The number of the nearest centre."""
    @F.pandas_udf("int")
    def number(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        parts = [nearest(points[i : i + 1024], centres) for i in range(0, len(points), 1024)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="int32")

    return number(*[F.col(f).cast("double") for f in features])
