"""Shards by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are a group and stay together. Groups enter by falling size the shard with the least free
space that still holds them, which a balanced tree of the open shards finds; where none does, a
shard opens. Groups of one size need no order among themselves, and while the tightest shard has
room it stays the tightest, so a whole size class is placed with a few look-ups and the result is that
of placing group by group. The driver sees one row per size: k different sizes add up to at least
k * (k + 1) / 2 bytes, so T bytes of text have at most sqrt(2 T) of them. Spark does the rest: grouping,
ranking groups within their size, and numbering rows in shards, all by even slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.storage import cut
from shelfwise.llm.arrow import table

ROW_BYTES = 16  # counted for each row besides its text
HOT_SHARE = 100  # groups with more than one in so many rows, at most 99, are joined by broadcast
_SLACK = 2.0**-20  # how closely the least capacity for a number of shards is looked for, as a share of the mean


class OpenShards:
    """Shards by (free bytes, number) in a treap: a search tree balanced by pseudo-random priorities."""

    def __init__(self):
        self.root, self.seed = None, 1

    def add(self, free: int, shard: int) -> None:
        self.seed = self.seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        low, high = self._split(self.root, (free, shard))
        self.root = self._merge(self._merge(low, [(free, shard), self.seed >> 32, None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the shard with the least free space of at least ``size``, lowest number first."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        _, high = self._split(high, (node[0][0], node[0][1] + 1))
        self.root = self._merge(low, high)
        return node[0]

    def _split(self, node, key):
        """(below key, the others)."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return high if low is None else low
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit_decreasing(sizes: list[int], counts: list[int], capacity: int, most: int | None = None,
                        ) -> list[tuple[int, int, int]] | None:
    """(class, shard, groups) in the order of placing; None when more than ``most`` shards are needed.

    ``sizes`` falls strictly; ``counts`` says how many groups have each size. Groups beyond the capacity get a shard each.
    """
    tree, shards, placed = OpenShards(), 0, []
    for which, (size, left) in enumerate(zip(sizes, counts)):
        while left:
            free, shard = tree.take_tightest(size) or (max(capacity, size), shards)
            if shard == shards:
                if shards == most:
                    return None
                shards += 1
            fits = min(left, free // size)
            placed.append((which, shard, fits))
            tree.add(free - fits * size, shard)
            left -= fits
    return placed


def even_shards(sizes: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int]]:
    """(class, shard, groups) in the order of placing, in at most ``shards`` shards of near equal size.

    A group above the mean of what is left gets a shard of its own. For the others the capacity is the
    least, to a millionth of the mean, with which best fit was seen to need no more than the shards left.
    """
    placed, rest, left = [], sum(s * c for s, c in zip(sizes, counts)), shards
    counts = list(counts)
    for which, size in enumerate(sizes):
        while counts[which] and left > 1 and size * left > rest:
            placed.append((which, shards - left, 1))
            counts[which] -= 1
            rest, left = rest - size, left - 1
        if counts[which]:
            break
    mean = -(-rest // left)
    step, failed, slack = max(int(mean * _SLACK), 1), -1, 0
    while (packed := best_fit_decreasing(sizes, counts, mean + slack, left)) is None:
        failed, slack = slack, max(2 * slack, step)
    while slack - failed > step:
        middle = (slack + failed) // 2
        tried = best_fit_decreasing(sizes, counts, mean + middle, left)
        failed, slack, packed = (middle, slack, packed) if tried is None else (failed, middle, tried)
    return placed + [(which, shards - left + shard, groups) for which, shard, groups in packed]


def _rows(docs: DataFrame, id: str, text: str, *more) -> DataFrame:
    """(doc_id, size, text_crc32, key, ...): the key is the same for equal texts only."""
    content = F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")
    return docs.select(
        docs[id].cast("long").alias("doc_id"), (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"), F.unhex(F.sha2(content, 256)).alias("key"), *more)


def _places(classes: pa.Table, placed: list[tuple[int, int, int]], number: dict[int, int]) -> pa.Table:
    """(_slice, bytes, upto, shards): for the groups of a size in a slice, by rank, where each shard's ones end."""
    by_class: list[list[tuple[int, int]]] = [[] for _ in number]
    for which, shard, groups in placed:
        by_class[which].append((shard, groups))
    ends, shards = [], []
    size_before, queue, used = None, [], 0
    for size, groups in zip(classes["bytes"].to_pylist(), classes["groups"].to_pylist()):
        if size != size_before:
            size_before, queue, used = size, iter(by_class[number[size]]), 0
            shard, left = next(queue)
        upto, to, rank = [], [], 0
        while rank < groups:
            if not left:
                shard, left = next(queue)
            step = min(left, groups - rank)
            rank, left = rank + step, left - step
            upto.append(rank)
            to.append(shard)
        ends.append(upto)
        shards.append(to)
    return pa.table({"_slice": classes["_slice"], "bytes": classes["bytes"],
                     "upto": pa.array(ends, pa.list_(pa.int64())), "shards": pa.array(shards, pa.list_(pa.int32()))})


def placed_groups(rows: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """(key, copies, shard) for the groups of ``rows`` (key, size).

    With ``shards``: near equal bytes in that many. With ``capacity``: as few shards of at most that many bytes as
    best fit decreasing finds; groups beyond the capacity get a shard each.
    """
    if (shards is None) == (capacity is None) or (capacity if shards is None else shards) < 1:
        raise ValueError("give either the number of shards or the capacity, at least 1")
    spark = rows.sparkSession
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies"))
    # Slices by size and key: a size of which there are many groups spreads over many slices.
    sliced = cut(groups.repartitionByRange("bytes", "key").withColumn("_slice", F.spark_partition_id()))
    classes = sliced.groupBy("_slice", "bytes").agg(F.count("*").alias("groups")).toArrow()
    classes = classes.sort_by([("bytes", "descending"), ("_slice", "ascending")])
    size, groups_of = classes["bytes"].to_numpy(), classes["groups"].to_numpy()
    first = np.flatnonzero(np.concatenate([[True], size[1:] != size[:-1]])[: len(size)])
    sizes, counts = size[first].tolist(), np.add.reduceat(groups_of, first).tolist() if len(first) else []
    placed = even_shards(sizes, counts, shards) if shards is not None else best_fit_decreasing(sizes, counts, capacity)
    places = spark.createDataFrame(_places(classes, placed, {s: i for i, s in enumerate(sizes)}))
    rank = F.row_number().over(Window.partitionBy("_slice", "bytes").orderBy("key"))
    at = F.size(F.filter("upto", lambda end: end < F.col("_rank"))) + 1
    return sliced.withColumn("_rank", rank).join(places, ["_slice", "bytes"]).select(
        "key", "copies", F.element_at("shards", at).alias("shard"))


def _with_shard(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """The rows with their group's shard; the few groups that hold a large share of the rows are broadcast."""
    hot = groups.where(F.col("copies") * HOT_SHARE > total).select("key", "shard")  # fewer than HOT_SHARE rows
    rest = groups.where(F.col("copies") * HOT_SHARE <= total).select("key", "shard")
    others = rows.join(F.broadcast(hot.select("key")), "key", "left_anti")
    return rows.join(F.broadcast(hot), "key").unionByName(others.join(rest, "key"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and each row's number among the rows of its shard in the task."""
    seen: dict[int, int] = {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        order = np.argsort(shard, kind="stable")
        values, first, count = np.unique(shard[order], return_index=True, return_counts=True)
        nth = np.empty(len(shard), np.int64)
        nth[order] = np.arange(len(shard)) - np.repeat(first - [seen.get(v, 0) for v in values.tolist()], count)
        for v, c in zip(values.tolist(), count.tolist()):
            seen[v] = seen.get(v, 0) + c
        yield table(doc_id=batch.column("doc_id"), size=batch.column("size"), text_crc32=batch.column("text_crc32"),
                    shard=batch.column("shard"), nth=nth, task=np.full(len(shard), TaskContext.get().partitionId(), np.int64))


def shard(docs: DataFrame, shards: int | None = None, capacity: int | None = None,
          id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row's place; see ``placed_groups`` for the two ways.

    ``size`` is the text's UTF-8 bytes plus 16. Shards are numbered from 0, and so are the slots in each shard,
    without gaps, in no particular order. A null text counts as empty, and all empty ones are one group;
    repeated rows and null ids are rows like others; an empty table gives an empty result; other
    columns are ignored. With fewer groups than shards some shards stay empty.
    """
    rows = cut(_rows(docs, id, text))
    groups = cut(placed_groups(rows, shards, capacity))
    placed = _with_shard(rows, groups, rows.count()).select("doc_id", "size", "text_crc32", "shard")
    numbered = cut(placed.mapInArrow(_numbered, "doc_id long, size long, text_crc32 long, shard int, nth long, task long"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = numbered.groupBy("shard", "task").agg(F.count("*").alias("_n")).select(
        "shard", "task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("begin"))
    return numbered.join(begins, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("nth")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int | None = None, capacity: int | None = None,
                 id: str = "doc_id", text: str = "text") -> None:
    """Writes the rows (doc_id, text) as Parquet, one folder ``shard=N`` for each shard; as ``shard`` places them."""
    groups = cut(placed_groups(_rows(docs, id, text).select("key", "size"), shards, capacity))
    rows = _rows(docs, id, text, docs[text].cast("string").alias("text")).select("doc_id", "text", "key")
    _with_shard(rows, groups, docs.count()).drop("key").write.partitionBy("shard").parquet(path)
