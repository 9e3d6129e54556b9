"""Clustering and its quality measures.

Points are tables with a key column and numeric feature columns; a clustered table also has an
integer ``cluster`` column. What is known per cluster (centres, sizes) is a table of k rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.lookup import left_lookup
from shelfwise.functions.quantiles import exact_quantiles
from shelfwise.functions.storage import cut
from shelfwise.operators.kmeans import cluster_of, fit_many
from shelfwise.operators.partners import best_other

MICRO_CLUSTERS = 500
FEW_CLUSTERS = 200  # so many centres are held against every row; beyond, a grid is used
TILE = (64, 1024)  # points on both sides of a tile of distances, which stays in the processor's cache
MOST_BLOCKS = 64  # blocks of the exact silhouette; beyond, they grow, since pairs of blocks are tasks
MOST_SUMS = 1 << 24  # points of a block times clusters
MOST_TASKS = 4000  # tasks for the pairs of blocks
LINKAGES = ("ward", "average", "complete")


def _vectors(df: DataFrame, features: Sequence[str], output: str = "_vector") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


def _square(values: Sequence[Column]) -> Column:
    return sum((v * v for v in values[1:]), values[0] * values[0])


def fit_kmeans(
    df: DataFrame, features: Sequence[str], k: int = 5, *, n_init: int = 10, max_iter: int = 300, seed: int = 42
) -> tuple[DataFrame, float]:
    """(df with ``cluster``, inertia): the best of ``n_init`` k-means runs.

    A run stops when the centres' squared shifts are below 1e-4 of the mean feature variance.
    Clusters are numbered in the order of their centres, so numbers do not depend on the run.
    """
    centres, inertia = fit_many(df, features, [k], n_init=n_init, max_iter=max_iter, seed=seed)[k]
    return df.withColumn("cluster", cluster_of(features, centres)), inertia


def lloyd(
    df: DataFrame, features: Sequence[str], start: Sequence[Sequence[float]], rounds: int = 12
) -> tuple[DataFrame, list[list[float]]]:
    """(df with ``cluster``, centres): k-means from given centres, the same for every run.

    A round gives each row to its nearest centre, the first among ties, and moves centres to the means of their rows; a
    centre without rows stays. It ends when no centre moves. Clusters are numbered in the order of their centres.
    """
    centres = [[float(v) for v in c] for c in start]

    def nearest(centres):
        gaps = [F.struct(_square([F.col(f) - v for f, v in zip(features, c)]).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
        return F.least(*gaps)["i"] if len(gaps) > 1 else F.lit(0)

    for _ in range(rounds):
        moved = df.groupBy(nearest(centres).alias("i")).agg(*[F.avg(f).alias(f) for f in features])
        means = {r["i"]: [r[f] for f in features] for r in moved.collect()}  # k rows
        before, centres = centres, [means.get(i, c) for i, c in enumerate(centres)]
        if centres == before:
            break
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    centres = [centres[i] for i in order]
    return df.withColumn("cluster", nearest(centres).cast("int")), centres


def quantile_start(df: DataFrame, features: Sequence[str], k: int) -> list[list[float]]:
    """k centres along the diagonal of the data: the same quantile, (i + 1/2) / k, of every feature."""
    shares = [(i + 0.5) / k for i in range(k)]
    found = exact_quantiles(df, features, shares)
    return [[found[f][i] for f in features] for i in range(k)]


def segment_letters(cluster: Column) -> Column:
    """'Segment A' for cluster 0, 'Segment B' for 1 and so on; after Z come AA, AB, ..."""
    letter = lambda n: F.char(65 + n)
    high = F.floor(cluster / 26)
    return F.concat(F.lit("Segment "), F.when(high > 0, letter(high - 1)).otherwise(""), letter(cluster % 26))


def linkage_labels(centres: np.ndarray, sizes: np.ndarray, k: int, linkage: str) -> np.ndarray:
    """Agglomerates weighted points down to k groups by the Lance-Williams update."""
    n = len(centres)
    gaps = ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(-1)
    weight = sizes.astype(float)
    if linkage == "ward":
        d = gaps * 2 * np.outer(weight, weight) / np.add.outer(weight, weight)
    else:
        d = np.sqrt(gaps)
    np.fill_diagonal(d, np.inf)
    label = np.arange(n)
    for _ in range(n - k):
        i, j = sorted(np.unravel_index(np.argmin(d), d.shape))
        if linkage == "ward":
            total = weight[i] + weight[j] + weight
            row = ((weight + weight[i]) * d[i] + (weight + weight[j]) * d[j] - weight * d[i, j]) / total
        elif linkage == "average":
            row = (weight[i] * d[i] + weight[j] * d[j]) / (weight[i] + weight[j])
        else:
            row = np.maximum(d[i], d[j])
        d[i], d[:, i] = row, row
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        weight[i] += weight[j]
        label[label == j] = i
    return label


def fit_hac(
    df: DataFrame, key: str, features: Sequence[str], k: int = 5, linkage: str = "ward", *,
    micro: int = MICRO_CLUSTERS, n_init: int = 10, max_iter: int = 300, seed: int = 42,
) -> DataFrame:
    """``df`` with ``cluster`` from agglomerative clustering of micro-clusters.

    At every size the points are first grouped by k-means into at most ``micro`` micro-clusters, whose
    centres and sizes are then merged; only those centres reach the driver. ``micro`` is a parameter
    of the method: it bounds how finely the merging sees the points.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    features = list(features)
    grouped, _ = fit_kmeans(df, features, micro, n_init=n_init, max_iter=max_iter, seed=seed)
    placed, on = cut(grouped.withColumnRenamed("cluster", "_micro")), ["_micro"]
    groups = placed.groupBy("_micro").agg(*[F.avg(f).alias(f) for f in features], F.count("*").alias("_size"))
    rows = groups.orderBy(*features).toPandas()  # at most ``micro`` rows
    k = min(k, len(rows))
    found = linkage_labels(rows[features].to_numpy(dtype=float), rows["_size"].to_numpy(), k, linkage)
    _, rows["cluster"] = np.unique(found, return_inverse=True)
    labels = df.sparkSession.createDataFrame(rows[[*on, "cluster"]]).withColumn("cluster", F.col("cluster").cast("int"))
    return placed.join(F.broadcast(labels), on).select(*df.columns, "cluster")


def centroids(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """(cluster, size, one mean per feature)."""
    return clustered.groupBy("cluster").agg(F.count("*").alias("size"), *[F.avg(f).alias(f) for f in features])


def _spread(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """(cluster, size, centre, scatter, within): centre, mean distance to it and sum of squared distances."""
    centres = centroids(clustered, features).withColumnsRenamed({f: f"_centre_{f}" for f in features})
    joined = left_lookup(clustered.select("cluster", *features), centres, "cluster")
    squared = _square([F.col(f) - F.col(f"_centre_{f}") for f in features])
    means = [F.first(f"_centre_{f}").alias(f) for f in features]
    return joined.groupBy("cluster").agg(
        F.count("*").alias("size"), F.array(*[F.first(f"_centre_{f}") for f in features]).alias("centre"),
        F.avg(F.sqrt(squared)).alias("scatter"), F.sum(squared).alias("within"), *means,
    )


def _gap(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def davies_bouldin(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """(davies_bouldin): mean over clusters of the worst scatter-to-separation ratio; null below 2 clusters.

    Up to ``FEW_CLUSTERS`` clusters each is held against all; more are looked up in a grid over the centres.
    """
    spread = cut(_spread(clustered, features).select("cluster", "centre", "scatter"))
    if spread.count() > FEW_CLUSTERS:
        centres = spread.select("cluster", F.col("centre").alias("position"), F.col("scatter").alias("trait"))
        ratio = lambda gap, a, b: -F.try_divide(a + b, F.sqrt(gap))
        worst = best_other(centres.withColumn("id", F.col("cluster")), centres, len(features), ratio, largest_trait=True)
        return worst.agg(F.avg(-F.col("best")).alias("davies_bouldin"))
    everyone = spread.agg(F.collect_list(F.struct("cluster", "centre", "scatter")).alias("all")).scalar()  # k entries
    others = F.filter("all", lambda o: o["cluster"] != F.col("cluster"))
    ratios = F.transform(others, lambda o: (F.col("scatter") + o["scatter"]) / _gap(F.col("centre"), o["centre"]))
    return spread.withColumn("all", everyone).select(F.array_max(ratios).alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def calinski_harabasz(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """(calinski_harabasz): between over within variance, each per degree of freedom."""
    spread = _spread(clustered, features)
    n, k = F.sum("size"), F.count("*")
    # sum of size * |centre - mean|^2 = sum of size * centre^2 - n * mean^2, feature by feature
    between = sum(
        F.sum(F.col("size") * F.col(f) * F.col(f)) - F.pow(F.sum(F.col("size") * F.col(f)), F.lit(2.0)) / n for f in features
    )
    within = F.sum("within")
    value = F.when((k > 1) & (n > k), F.when(within == 0, 1.0).otherwise((between / (k - 1)) / (within / (n - k))))
    return spread.agg(value.alias("calinski_harabasz"))


def _silhouette_of(own: Column, other: Column, size: Column) -> Column:
    top = F.greatest(own, other)
    return F.when(size <= 1, 0.0).when(top == 0, 0.0).otherwise((other - own) / top)


def _silhouette_by_grid(clustered: DataFrame, features: Sequence[str], moments: DataFrame) -> DataFrame:
    """A cluster's mean squared distance to a point is the squared gap to its centre plus the cluster's variance."""
    position = F.array(*[F.col(f).cast("double") for f in features])
    points = cut(clustered.select("cluster", position.alias("position"), F.monotonically_increasing_id().alias("id")))
    variance = F.greatest(F.col("square") - _length("centre"), F.lit(0.0)).alias("trait")
    centres = moments.select("cluster", "size", F.col("centre").alias("position"), variance)
    other = best_other(points.withColumn("trait", F.lit(0.0)), centres.drop("size"), len(features), lambda gap, _, b: gap + b, largest_trait=False)
    mine = left_lookup(points, centres.select("cluster", "size", F.col("position").alias("_centre"), F.col("trait").alias("_variance")), "cluster")
    gap = F.aggregate(F.zip_with("position", "_centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    own = (gap + F.col("_variance")) * F.col("size") / F.greatest(F.col("size") - 1, F.lit(1))
    parts = mine.select("id", "size", own.alias("own")).join(other, "id")
    return parts.agg(F.avg(F.when(F.col("best").isNotNull(), _silhouette_of(F.col("own"), F.col("best"), F.col("size")))).alias("silhouette"))


def _length(values: str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x)


def silhouette_squared(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """(silhouette) by squared distance, in one pass: a cluster's mean squared distance to a point
    follows from its size, centre and mean square. Null below 2 clusters. Up to ``FEW_CLUSTERS`` clusters
    every point is held against all; more are looked up in a grid over the centres."""
    norm = _square([F.col(f) for f in features])
    moments = cut(clustered.groupBy("cluster").agg(
        F.count("*").alias("size"), F.array(*[F.avg(f) for f in features]).alias("centre"), F.avg(norm).alias("square")
    ))
    if moments.count() > FEW_CLUSTERS:
        return _silhouette_by_grid(clustered, features, moments)
    everyone = moments.agg(F.collect_list(F.struct("cluster", "size", "centre", "square")).alias("all")).scalar()  # k entries

    def to(o: Column) -> Column:
        dot = sum((F.col(f) * o["centre"][i] for i, f in enumerate(features[1:], 1)), F.col(features[0]) * o["centre"][0])
        return F.greatest(norm - 2 * dot + o["square"], F.lit(0.0))

    mine = F.filter("all", lambda o: o["cluster"] == F.col("cluster"))[0]
    others = F.transform(F.filter("all", lambda o: o["cluster"] != F.col("cluster")), to)
    parts = clustered.withColumn("all", everyone).select(
        mine["size"].alias("size"), (to(mine) * mine["size"] / F.greatest(mine["size"] - 1, F.lit(1))).alias("own"),
        F.array_min(others).alias("other"),
    )
    return parts.agg(F.avg(F.when(F.col("other").isNotNull(), _silhouette_of(F.col("own"), F.col("other"), F.col("size")))).alias("silhouette"))


def _distance_sums(a: np.ndarray, b: np.ndarray, starts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(per cluster of b the sums of distances from each point of a, per cluster of a those from each of b).

    ``starts`` are the places where clusters begin in a and b. Distances are made tile by tile, from the first point.
    """
    a, b = a - b[0], b - b[0]
    left = np.column_stack([-2 * a, (a * a).sum(1), np.ones(len(a))])
    right = np.vstack([b.T, np.ones(len(b)), (b * b).sum(1)])
    to_b, to_a = np.zeros((len(starts[1]), len(a))), np.zeros((len(starts[0]), len(b)))

    def within(at: np.ndarray, i: int, last: int) -> tuple[slice, np.ndarray]:  # clusters of a stretch, their first places
        own = slice(np.searchsorted(at, i, "right") - 1, np.searchsorted(at, last))
        return own, np.maximum(at[own] - i, 0)

    def summed(gaps: np.ndarray, at: np.ndarray, axis: int) -> np.ndarray:  # a plain sum is twice as fast
        return np.add.reduceat(gaps, at, axis=axis) if len(at) > 1 else gaps.sum(axis, keepdims=True)

    for i in range(0, len(a), TILE[0]):
        rows = slice(i, min(i + TILE[0], len(a)))
        mine, row_starts = within(starts[0], rows.start, rows.stop)
        for j in range(0, len(b), TILE[1]):
            columns = slice(j, min(j + TILE[1], len(b)))
            others, column_starts = within(starts[1], columns.start, columns.stop)
            gaps = left[rows] @ right[:, columns]
            np.sqrt(np.maximum(gaps, 0, out=gaps), out=gaps)
            to_b[others, rows] += summed(gaps, column_starts, 1).T
            to_a[mine, columns] += summed(gaps, row_starts, 0)
    return to_b, to_a


def silhouette_exact(clustered: DataFrame, key: str, features: Sequence[str], block_rows: int = 20_000) -> DataFrame:
    """(silhouette) by Euclidean distance.

    The definition needs every distance, so the work is quadratic; for large tables use
    ``silhouette_squared``. Points are packed into blocks cluster by cluster, at most about ``MOST_BLOCKS`` of them
    unless sums to many clusters ask for smaller ones (``MOST_SUMS`` a block); a pair of blocks is measured once for
    both directions, and only sums per (point, cluster) leave its task.
    """
    features = list(features)
    width = len(features)
    sizes = cut(clustered.groupBy("cluster").agg(F.count("*").alias("size")))
    n, k = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    block_rows = max(1, min(max(block_rows, ceil(n / MOST_BLOCKS)), MOST_SUMS // max(k, 1)))
    blocks = ceil(n / block_rows)
    before = F.sum("size").over(Window.orderBy("cluster")) - F.col("size")  # one row per cluster
    place = F.floor((F.col("_before") + F.pmod(F.xxhash64(key), F.col("size"))) / block_rows)
    packed = cut(
        left_lookup(clustered.select(key, "cluster", *features), sizes.withColumn("_before", before), "cluster")
        .select(place.alias("block"), F.struct("cluster", "size", *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]).alias("row"))
        .groupBy("block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select("block", F.col("rows.cluster").alias("clusters"), F.col("rows.size").alias("sizes"),
                *[F.col(f"rows.x{i}").alias(f"x{i}") for i in range(width)])
    )
    held = ["clusters", *[f"x{i}" for i in range(width)]]
    left = packed.select("block", F.explode(F.sequence("block", F.lit(max(blocks, 1) - 1).cast("long"))).alias("other"), *held)
    right = packed.select(F.col("block").alias("other"), *[F.col(c).alias(f"other_{c}") for c in held])

    def measure(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                points = [np.column_stack([getattr(row, f"{side}x{i}") for i in range(width)]) for side in ("", "other_")]
                names, starts = zip(*(np.unique(c, return_index=True) for c in (row.clusters, row.other_clusters)))
                to_b, to_a = _distance_sums(*points, starts)
                out = [(row.block, int(c), sums) for c, sums in zip(names[1], to_b)]
                if row.other != row.block:
                    out += [(row.other, int(c), sums) for c, sums in zip(names[0], to_a)]
                yield pd.DataFrame(out, columns=["block", "towards", "sums"])

    work = left.join(right, "other").repartition(max(1, min(blocks * (blocks + 1) // 2, MOST_TASKS)))
    sums = work.mapInPandas(measure, "block long, towards int, sums array<double>")
    counted = sums.join(sizes.select(F.col("cluster").alias("towards"), F.col("size").alias("their_size")), "towards")

    def score(mine, found):
        clusters, size = np.asarray(mine["clusters"].iloc[0]), np.asarray(mine["sizes"].iloc[0])
        own, other = np.zeros(len(size)), np.full(len(size), np.inf)
        for (towards, their_size), group in found.groupby(["towards", "their_size"]):
            total, same = np.sum(np.stack(group["sums"].tolist()), axis=0), clusters == towards
            own = np.where(same, total / np.maximum(size - 1, 1), own)
            other = np.where(same, other, np.minimum(other, total / their_size))
        top = np.maximum(own, other)
        scores = np.where((size > 1) & (top > 0), (other - own) / np.where(top > 0, top, 1), 0.0)[np.isfinite(other)]
        return pd.DataFrame({"total": [scores.sum()], "n": [len(scores)]})

    parts = packed.select("block", "clusters", "sizes").groupBy("block").cogroup(counted.groupBy("block"))
    scores = parts.applyInPandas(score, "total double, n long")
    return scores.agg(F.try_divide(F.sum("total"), F.sum("n")).alias("silhouette"))


def silhouette(
    clustered: DataFrame, key: str, features: Sequence[str], method: str = "squared", exclude_noise: bool = False
) -> DataFrame:
    """(silhouette), 0 below two clusters; noise (cluster -1) counts as a cluster unless excluded.

    ``method="euclidean"`` measures every pair of points, so its work is quadratic.
    """
    if exclude_noise:
        clustered = clustered.where("cluster <> -1")
    if method == "euclidean":
        score = silhouette_exact(clustered, key, features)
    elif method == "squared":
        score = silhouette_squared(clustered, features)
    else:
        raise ValueError("method must be 'euclidean' or 'squared'")
    return score.select(F.coalesce("silhouette", F.lit(0.0)).alias("silhouette"))


def evaluate(clustered: DataFrame, key: str, features: Sequence[str], method: str = "squared") -> DataFrame:
    """(metric, value): cluster count, silhouette, Davies-Bouldin, Calinski-Harabasz and size of each cluster.

    Below two clusters there is a single 'error' line without a value.
    """
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("size"))
    line = lambda metric, value: [metric.alias("metric"), value.cast("double").alias("value")]
    count = sizes.agg(F.count("*").alias("n"))
    table = count.select(*line(F.lit("n_clusters"), F.col("n")))
    for score in (
        silhouette(clustered, key, features, method),
        davies_bouldin(clustered, features),
        calinski_harabasz(clustered, features),
    ):
        name = score.columns[0]
        table = table.unionByName(score.select(*line(F.lit(name), F.col(name))))
    table = table.unionByName(sizes.select(*line(F.format_string("size_%d", "cluster"), F.col("size"))))
    enough = count.scalar() >= 2
    error = count.where("n < 2").select(*line(F.lit("error: need at least 2 clusters"), F.lit(None)))
    return table.where(enough).unionByName(error)


def find_k(
    df: DataFrame, key: str, features: Sequence[str], k_range: Sequence[int] = range(2, 11), *,
    clustering: str = "kmeans", method: str = "squared", n_init: int = 10, seed: int = 42,
) -> DataFrame:
    """(k, inertia, silhouette, davies_bouldin, calinski_harabasz, best): best marks the first highest silhouette."""
    df = cut(df.select(key, *features))
    rows = []
    found = fit_many(df, features, list(k_range), n_init=n_init, seed=seed) if clustering == "kmeans" else {}
    for k in k_range:
        if clustering == "kmeans":
            centres, inertia = found[k]
            clustered = df.withColumn("cluster", cluster_of(features, centres))
        elif clustering == "hac":
            clustered, inertia = fit_hac(df, key, features, k, n_init=n_init, seed=seed), 0.0
        else:
            raise ValueError("clustering must be 'kmeans' or 'hac'")
        clustered = cut(clustered)  # read by three measures
        score = silhouette(clustered, key, features, method).first()[0]
        dbi, ch = davies_bouldin(clustered, features).first()[0], calinski_harabasz(clustered, features).first()[0]
        rows.append((k, inertia, score, float("inf") if dbi is None else dbi, ch or 0.0))
    best = min(rows, key=lambda row: (-row[2], row[0]))[0]
    return df.sparkSession.createDataFrame(
        [(*row, row[0] == best) for row in rows],
        "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double, best boolean",
    )


def profiles(clustered: DataFrame, features: Sequence[str]) -> DataFrame:
    """(cluster, mean of each feature, their std, min and max, size, percentage)."""
    others = [f(c).alias(f"{c}_{name}") for c in features for name, f in (("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    table = clustered.groupBy("cluster").agg(
        *[F.avg(c).alias(c) for c in features], *others, F.count("*").alias("size"))
    total = F.sum("size").over(Window.partitionBy())  # one row per cluster
    return table.withColumn("percentage", F.bround(F.col("size") / total * 100, 2))


def descriptions(profile: DataFrame) -> DataFrame:
    """(cluster, description): each cluster against the median of the cluster means."""
    # One row per cluster, so the exact median is small work.
    middle = profile.agg(F.struct(*[F.median(c).alias(c) for c in ("recency", "frequency", "monetary")]).alias("m")).scalar()
    words = F.concat_ws(
        ", ",
        F.when(F.col("recency") < middle["recency"], "Bought lately").otherwise("Quiet for long"),
        F.when(F.col("frequency") > middle["frequency"], "Orders often").otherwise("Orders rarely"),
        F.when(F.col("monetary") > middle["monetary"], "Spends much").otherwise("Spends little"),
    )
    text = F.format_string("Cluster %d: %s (%d customers, %s%%)", "cluster", words, "size", F.col("percentage").cast("string"))
    return profile.select("cluster", text.alias("description"))


def normalized_profiles(profile: DataFrame, features: Sequence[str]) -> DataFrame:
    """(cluster, features divided by their largest cluster mean when that is positive)."""
    top = profile.agg(F.struct(*[F.max(c).alias(c) for c in features]).alias("t")).scalar()
    scaled = [F.when(top[c] > 0, F.col(c) / top[c]).otherwise(F.col(c)).alias(c) for c in features]
    return profile.select("cluster", *scaled)


def cluster_report(profile: DataFrame) -> DataFrame:
    """(section, seq, text): cluster count, each cluster's size, description, and the largest and smallest cluster."""
    share = F.format_string("%d customers (%s%%)", "size", F.col("percentage").cast("string"))
    line = lambda section, seq, text: [F.lit(section).alias("section"), seq.cast("int").alias("seq"), text.alias("text")]
    extreme = lambda word, pick: profile.agg(
        pick(F.struct("cluster", "size", "percentage")).alias("c")
    ).select(*line(f"{word.lower()}_cluster", F.lit(1), F.format_string(
        f"{word} cluster: %d with %d customers (%s%%)", "c.cluster", "c.size", F.col("c.percentage").cast("string"))))
    first = lambda f, sign: lambda s: f(s, F.struct(sign * F.col("size"), F.col("cluster")))
    return (
        profile.agg(F.count("*").alias("n")).select(*line("n_clusters", F.lit(1), F.col("n").cast("string")))
        .unionByName(profile.select(*line("cluster_size", F.col("cluster"), share)))
        .unionByName(descriptions(profile).select(*line("description", F.col("cluster"), F.col("description"))))
        .unionByName(extreme("Largest", first(F.min_by, -1)))
        .unionByName(extreme("Smallest", first(F.min_by, 1)))
    )


def pca_2d(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, component_1, component_2): centred principal coordinates.

    The sign of a component is fixed so that its largest loading is positive.
    """
    features = list(features)
    means = df.agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("m")).scalar()
    centred = df.select(key, *[(F.col(f) - means[f]).alias(f) for f in features])
    vectors = _vectors(centred, features)
    model = PCA(k=2, inputCol="_vector", outputCol="_components").fit(vectors)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.abs(loadings[:, i]).argmax(), i]) or 1.0) for i in range(2)]
    parts = vector_to_array("_components")
    return model.transform(vectors).select(
        key, *[(parts[i] * signs[i]).alias(f"component_{i + 1}") for i in range(2)]
    )
