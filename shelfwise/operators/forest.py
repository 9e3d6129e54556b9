"""Random forests grown tree by tree inside tasks, kept as a table of trees.

The library's forest holds counts for all nodes of a pass in every task and all trees on the driver, so its work grows
with nodes times tasks. Here a task gets all training rows as one byte per feature and grows whole trees on them by the
library's rules: bins of equal frequency, Poisson bootstrap, a drawn subset of features per node, Gini gain, equal
sibling leaves merged. Trees stay in a table; predictions are votes added up per block of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.storage import cut

CELLS = 1 << 18  # counts of a task by node, bin and class that are looked at together
BLOCK_BITS = 14  # rows of a block that is predicted together, as a power of two
MOST_CODES = 256  # bins and classes, which are held in one byte each
PURE = 2.0**-52  # impurity below which a node is a leaf
TREE = "group int, tree int, feature array<int>, threshold array<double>, first array<int>, gain array<double>, counts array<int>"


def _values(batch: pa.RecordBatch | pa.Table, width: int) -> list[np.ndarray]:
    """The first ``width`` columns; features that are missing cannot be compared with a threshold."""
    columns = [c.to_numpy() if isinstance(c, pa.ChunkedArray) else c.to_numpy(zero_copy_only=False) for c in batch.columns[:width]]
    if any(np.isnan(c).any() for c in columns):
        raise ValueError("features must not be null or NaN")
    return columns


def thresholds(xs: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 ascending thresholds: between all values if they are few, else where the rows are shared evenly."""
    values, counts = np.unique(xs, return_counts=True)
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < bins:
        return middles
    upto = np.cumsum(counts)
    nearer = (upto[:-1] + upto[1:]) / 2  # a threshold goes before the value that would lead further away from its share
    stride, found, at = len(xs) / bins, [], 0
    while len(found) < bins - 1:
        at = max(at, np.searchsorted(nearer, stride * (len(found) + 1), "right"))
        if at >= len(middles):
            break
        found.append(middles[at])
        at += 1
    return np.array(found)


def _gini(counts: Sequence[np.ndarray], size: np.ndarray) -> np.ndarray:
    left = np.ones_like(size)
    for n in counts:
        share = n / size
        left -= share * share
    return left


def _best_splits(codes, labels, weights, rows, counts, tried, bins, least_leaf):
    """(gain, feature, last bin on the left, class counts on the left) of each node; rows lie in the order of their nodes."""
    nodes, classes = counts.shape
    gains, features, places, lefts = np.zeros(nodes), np.zeros(nodes, int), np.zeros(nodes, int), np.zeros((nodes, classes))
    ends, step = np.cumsum(rows), max(1, CELLS // (bins * classes))
    for a in range(0, nodes, step):
        b = min(nodes, a + step)
        start, end, m = ends[a] - rows[a], ends[b - 1], b - a
        node, total = np.repeat(np.arange(m), rows[a:b]), counts[a:b].T
        cell, at, size = (labels[start:end] * m + node) * bins, np.arange(start, end), total.sum(0)
        impurity = _gini(total, size)
        for j in range(tried.shape[1]):
            held = np.bincount(cell + codes[tried[a:b, j][node], at], weights[start:end], classes * m * bins).reshape(classes, m, bins)
            left = np.cumsum(held, axis=2, out=held)
            here = left.sum(0)
            there = size[:, None] - here
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = impurity[:, None] - here / size[:, None] * _gini(left, here) - there / size[:, None] * _gini(total[:, :, None] - left, there)
            gain[(here < least_leaf) | (there < least_leaf)] = -1.0
            place = gain.argmax(1)
            found = gain[np.arange(m), place]
            better = np.flatnonzero(found > gains[a:b])
            gains[a + better], features[a + better], places[a + better] = found[better], tried[a + better, j], place[better]
            lefts[a + better] = left[:, better, place[better]].T
    return gains, features, places, lefts


def grow(
    codes: np.ndarray, labels: np.ndarray, weights: np.ndarray, classes: int, bins: int, tried: int, depth: int, least_leaf: int,
    least_split: int, rng: np.random.Generator,
) -> dict[str, np.ndarray]:
    """One tree, its nodes level by level and siblings side by side: feature (-1: leaf), last bin on the left, first child, gain, class counts.

    ``codes`` is features by rows. Sibling leaves that predict the same are merged from the bottom up; then nodes below ``least_split`` rows become leaves.
    """
    counts, rows = np.bincount(labels, weights, classes)[None], np.array([len(labels)])
    levels, level, known = [], 0, 0
    while True:
        nodes = len(counts)
        found = {"feature": np.full(nodes, -1), "place": np.zeros(nodes, int), "first": np.full(nodes, -1), "gain": np.zeros(nodes), "counts": counts}
        levels.append(found)
        known += nodes
        size = counts.sum(1)
        open = (size >= 2 * least_leaf) & (_gini(counts.T, np.maximum(size, 1)) > PURE)
        if level == depth or not open.any():
            break
        held = np.repeat(open, rows)
        codes, labels, weights, rows = codes[:, held], labels[held], weights[held], rows[open]
        drawn = rng.random((len(rows), len(codes))).argsort(1)[:, :tried] if tried < len(codes) else np.tile(np.arange(tried), (len(rows), 1))
        gain, feature, place, left = _best_splits(codes, labels, weights, rows, counts[open], drawn, bins, least_leaf)
        split = gain > 0
        if not split.any():
            break
        at = np.flatnonzero(open)[split]
        found["feature"][at], found["place"][at], found["gain"][at] = feature[split], place[split], gain[split]
        found["first"][at] = known + 2 * np.arange(len(at))
        held = np.repeat(split, rows)
        codes, labels, weights, rows = codes[:, held], labels[held], weights[held], rows[split]
        node = np.repeat(np.arange(len(at)), rows)
        child = 2 * node + (codes[feature[split][node], np.arange(len(node))] > place[split][node])
        # Rows of a node stay together: its left ones move before its right ones.
        order = np.argsort(child, kind="stable")
        codes, labels, weights, rows = codes[:, order], labels[order], weights[order], np.bincount(child, minlength=2 * len(at))
        counts = np.stack([left[split], counts[at] - left[split]], axis=1).reshape(-1, classes)
        level += 1
    ends = np.cumsum([len(x["gain"]) for x in levels])
    spans = [slice(end - len(x["gain"]), end) for end, x in zip(ends, levels)]
    tree = {name: np.concatenate([x[name] for x in levels]) for name in levels[0]}
    feature, first, guess = tree["feature"], tree["first"], tree["counts"].argmax(1)
    for span in reversed(spans):
        inner = span.start + np.flatnonzero(feature[span] >= 0)
        one, two = first[inner], first[inner] + 1
        feature[inner[(feature[one] < 0) & (feature[two] < 0) & (guess[one] == guess[two])]] = -1
    feature[tree["counts"].sum(1) < least_split] = -1
    reached = np.zeros(len(feature), bool)
    reached[0] = True
    for span in spans:
        children = first[span][reached[span] & (feature[span] >= 0)]
        reached[children] = reached[children + 1] = True
    place = np.cumsum(reached) - 1
    tree["first"] = np.where(feature >= 0, place[first], -1)
    return {name: column[reached] for name, column in tree.items()}


def _leaves(tree: dict, xs: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at, going = np.zeros(len(xs), int), np.arange(len(xs))
    while len(going):
        node = at[going]
        feature = tree["feature"][node]
        inner = feature >= 0
        going, node, feature = going[inner], node[inner], feature[inner]
        at[going] = tree["first"][node] + (xs[going, feature] > tree["threshold"][node])
    return at


@dataclass(frozen=True)
class Forest:
    """Trees as rows, class names in the order of their counts, and feature names."""

    name: str
    features: list[str]
    labels: list[str]
    trees: DataFrame

    def predict(self, df: DataFrame, key: str, target: str) -> DataFrame:
        """(key, y_true, y_pred, proba): proba maps each class to the mean of the trees' shares."""
        width, classes = len(self.features), len(self.labels)
        names = [f"x{i}" for i in range(width)]
        at = F.monotonically_increasing_id()
        placed = cut(df.select(
            *[F.col(f).cast("double").alias(n) for f, n in zip(self.features, names)], F.col(key).alias("key"), F.col(target).alias("y_true"),
            at.alias("at"), F.shiftright(at, BLOCK_BITS).alias("block")))
        packed = placed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", *names))).alias("rows"))
        blocks = packed.select("block", *[F.col(f"rows.{n}").alias(n) for n in names]).crossJoin(
            F.broadcast(self.trees.select(F.col("group").alias("of")).distinct()))

        def vote(trees: pa.Table, blocks: pa.Table) -> pa.Table:
            grown = []
            for row in trees.sort_by("tree").to_batches(max_chunksize=1):
                tree = {c: row[c].flatten().to_numpy(zero_copy_only=False) for c in ("feature", "threshold", "first", "counts")}
                counts = tree["counts"].reshape(-1, classes).astype(float)
                grown.append(tree | {"shares": counts / counts.sum(1, keepdims=True)})
            out = []
            for block in blocks.to_batches(max_chunksize=1):
                xs = np.column_stack(_values(pa.table([block[n].flatten() for n in names], names), width))
                sums = np.zeros((len(xs), classes))
                for tree in grown:
                    sums += tree["shares"][_leaves(tree, xs)]
                out.append((block["block"][0].as_py(), trees["group"][0].as_py(), sums.ravel()))
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.float64())]
            return pa.table([pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)] if out else [pa.array([], kind) for kind in kinds], ["block", "group", "votes"])

        votes = self.trees.groupBy("group").cogroup(blocks.groupBy("of")).applyInArrow(vote, "block long, group int, votes array<double>")

        def finish(rows: pa.Table, votes: pa.Table) -> pa.Table:
            rows, votes = rows.sort_by("at"), votes.sort_by("group")
            sums = votes["votes"].combine_chunks().flatten().to_numpy().reshape(votes.num_rows, rows.num_rows, classes).sum(0)
            shares = (sums / sums.sum(1, keepdims=True)).ravel()
            shares = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1) * classes, pa.int32()), pa.array(shares))
            return pa.table([rows["key"], rows["y_true"], pa.array(sums.argmax(1).astype(np.int32)), shares], ["key", "y_true", "guess", "shares"])

        kinds = {c: placed.schema[c].dataType.simpleString() for c in ("key", "y_true")}
        found = placed.select("block", "at", "key", "y_true").groupBy("block").cogroup(votes.groupBy("block")).applyInArrow(
            finish, f"key {kinds['key']}, y_true {kinds['y_true']}, guess int, shares array<double>")
        labels = F.array(*[F.lit(x) for x in self.labels])
        return found.select("key", "y_true", F.element_at(labels, F.col("guess") + 1).alias("y_pred"), F.map_from_arrays(labels, F.col("shares")).alias("proba"))

    def importances(self) -> np.ndarray:
        """Gain times rows of each feature's splits, as shares of their tree, then of all."""
        width, classes = len(self.features), len(self.labels)

        def weigh(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    feature, gain, counts = (row[c].flatten().to_numpy(zero_copy_only=False) for c in ("feature", "gain", "counts"))
                    inner = feature >= 0
                    weights = np.bincount(feature[inner], (gain * counts.reshape(-1, classes).sum(1))[inner], width)
                    yield pa.RecordBatch.from_arrays([row["tree"], pa.array([weights / (weights.sum() or 1.0)])], ["tree", "weights"])

        found = self.trees.mapInArrow(weigh, "tree int, weights array<double>").orderBy("tree").collect()  # one row per tree
        total = np.sum([r["weights"] for r in found], axis=0)
        return total / (total.sum() or 1.0)

    def save(self, path: str) -> None:
        """Writes trees and names; see ``load``."""
        spark = self.trees.sparkSession
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        names = spark.createDataFrame([(self.features, self.labels)], "features array<string>, labels array<string>")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")

    @staticmethod
    def load(spark: SparkSession, path: str, name: str) -> Forest:
        names = spark.read.parquet(f"{path}/forest").first()
        return Forest(name, list(names["features"]), list(names["labels"]), spark.read.parquet(f"{path}/trees"))

    @staticmethod
    def saved_in(spark: SparkSession, path: str) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/forest")
        return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def fit(
    rows: DataFrame, features: Sequence[str], label: str, labels: Sequence[str], name: str, *,
    trees: int, depth: int, bins: int, least_leaf: int, least_split: int, tried: int | None = None, bootstrap: bool = True, seed: int = 42,
) -> Forest:
    """A forest on rows whose ``label`` is a class's place in ``labels``; each node tries the square root of the features unless ``tried`` is given."""
    features, width, classes = list(features), len(features), len(labels)
    if max(classes, bins) > MOST_CODES:
        raise ValueError("classes and bins must fit one byte")
    tried = min(width, tried or ceil(sqrt(width)))
    groups = min(trees, rows.sparkSession.sparkContext.defaultParallelism)
    table = rows.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("int").alias("label"))

    def by_feature(batches):
        for batch in batches:
            held = [pa.array(range(width), pa.int32()), pa.array(_values(batch, width), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(held, ["feature", "xs"])

    def divided(table: pa.Table) -> pa.Table:
        found = thresholds(table["xs"].combine_chunks().flatten().to_numpy(), bins)
        return pa.table([table["feature"].slice(0, 1), pa.array([found], pa.list_(pa.float64()))], ["feature", "edges"])

    found = table.mapInArrow(by_feature, "feature int, xs array<double>").groupBy("feature").applyInArrow(divided, "feature int, edges array<double>")
    edges = [np.array(r["edges"], float) for r in found.orderBy("feature").collect()]

    def coded(batches):
        for batch in batches:
            codes = [np.searchsorted(e, x) for e, x in zip(edges, _values(batch, width))]  # a bin ends with its threshold
            block = np.column_stack([*codes, batch["label"].to_numpy()]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary())], ["block"])

    def grown(table: pa.Table) -> pa.Table:
        codes = np.frombuffer(b"".join(table["block"].to_pylist()), np.uint8).reshape(-1, width + 1)
        codes = np.ascontiguousarray(codes[np.lexsort(codes.T)].T)  # so that trees do not depend on how rows were dealt out
        group, out = table["group"][0].as_py(), []
        for tree in range(group, trees, groups):
            rng = np.random.default_rng([seed, tree])
            weights = rng.poisson(1.0, codes.shape[1]) if bootstrap else np.ones(codes.shape[1])
            held = weights > 0
            own = grow(codes[:-1, held], codes[-1, held].astype(np.int64), weights[held].astype(float), classes, bins, tried, depth, least_leaf, least_split, rng)
            feature, place = own["feature"], own["place"]
            threshold = np.array([edges[f][p] if f >= 0 else 0.0 for f, p in zip(feature, place)])
            out.append((group, tree, feature, threshold, own["first"], own["gain"], own["counts"].astype(np.int32).ravel()))
        whole, real = pa.list_(pa.int32()), pa.list_(pa.float64())
        kinds = [pa.int32(), pa.int32(), whole, real, whole, real, whole]
        return pa.table([pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)], [c.split()[0] for c in TREE.split(", ")])

    blocks = table.mapInArrow(coded, "block binary")
    work = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).repartitionById(groups, F.col("group"))
    return Forest(name, features, list(labels), cut(work.groupBy("group").applyInArrow(grown, TREE)))
