"""Exact n-gram Jaccard self-join by count vectors in R-trees.

A document is its set of word shingles. Shingles are hashed into GROUPS groups, and the numbers of
shingles per group are the document's point. Two sets overlap in at most the sum of the smaller
coordinates, which an R-tree bounds for all points of a node by the node's largest coordinates.

How the work is spread. Equal sets are folded first. Under one order of all shingles, in which those
of common parts of texts come last, sets that reach the similarity share one of their first few; sets
that share one are a cell. In each cell the points whose bound allows the similarity are joined, by
the cell's smallest set where that does it, else by R-tree; what hangs together is a family. Family
members are verified on their sets against the smallest, which settles copies of one text in one
pass. Those not connected then search the family's R-tree, on points only, at about one group per
shingle; the sets of those that find each other are fetched and verified too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.storage import cut
from shelfwise.llm.arrow import blobs, over_texts, table
from shelfwise.llm.links import components
from shelfwise.llm.texts import NOT_SPACE, Words, distinct, shingles, text_bytes

GROUPS = 256
BUCKET_KEYS = 100_000  # keys that meet in one group of the candidate search
CELL_MEMBERS = 4_000  # points of a cell that one task searches against each other, times two
CELL_ROWS = 16_000  # points of several cells that one task works through
HEADS = 6  # members of an unsettled family that all others are verified against
BLOCK_SHINGLES = 1_500_000  # shingles of a family that one task holds on either side
WIDE = 4  # blocks whose points, without their sets, one task holds on either side
FINEST = 1 << 14  # groups of the points of the largest sets
LEAF, FANOUT = 16, 8
BROADCAST_IDS = 1_000_000
COMMON_BITS = 20
COMMON_LEAST, COMMON_TIMES = 16, 8  # a hash range is common in a task from so many documents, and times the mean


def point(found: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Count vector of a sorted set; a group is a range of the hash, of which there are a power of two."""
    edges = np.arange(1, groups, dtype=np.uint64) << np.uint64(64 - groups.bit_length() + 1)
    counts = np.diff(np.concatenate([[0], np.searchsorted(found, edges), [len(found)]]))
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else np.uint32)


def points(raw: list[bytes], groups: int = GROUPS) -> np.ndarray:
    """Count vectors as one array from their bytes."""
    out = np.empty((len(raw), groups), np.int32)
    for i, r in enumerate(raw):
        out[i] = np.frombuffer(r, np.uint8 if len(r) == groups else np.uint32)
    return out


def fine_groups(size: int, percent: int) -> int:
    """Groups of the points in a size class: about one per shingle of its smallest sets."""
    least = (100.1 / percent) ** max(size, 0)
    return min(FINEST, max(GROUPS, 1 << int(np.ceil(np.log2(min(least, FINEST))))))


def first_shingles(found: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """So many of the first shingles that two sets with the similarity share one: all but the overlap needed, and one."""
    count = len(found) - -(-percent * len(found) // 100) + 1
    return found[np.argsort(common[found >> np.uint64(64 - COMMON_BITS)], kind="stable")[:count]]


def needed(a, b, percent: int):
    """The least overlap of sets of sizes a and b with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """R-tree over count vectors, packed bottom-up from points sorted by size and first coordinates."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*vectors[:, :4].T[::-1], sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        # Levels from the leaves up: largest coordinates and smallest size below each node.
        self.levels = [self._above(self.vectors, self.sizes, LEAF)]
        while len(self.levels[-1][0]) > FANOUT:
            self.levels.append(self._above(*self.levels[-1], FANOUT))

    @staticmethod
    def _above(vectors: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(0, len(sizes), width)
        return np.maximum.reduceat(vectors, at, axis=0), np.minimum.reduceat(sizes, at)

    def search(self, vector: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Places of the points whose summed coordinate minima with ``vector`` allow the similarity."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            vectors, sizes = self.levels[depth]
            nodes = nodes[np.minimum(vectors[nodes], vector).sum(axis=1) >= needed(sizes[nodes], size, percent)]
            width = FANOUT if depth else LEAF
            below = len(self.levels[depth - 1][0]) if depth else len(self.sizes)
            nodes = (nodes[:, None] * width + np.arange(width)).ravel()
            nodes = nodes[nodes < below]
        fits = np.minimum(self.vectors[nodes], vector).sum(axis=1) >= needed(self.sizes[nodes], size, percent)
        return self.order[nodes[fits]]


def text_sets(column: pa.Array, words_in: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(*text_bytes(column), NOT_SPACE)
    row, found = shingles(words, words_in)
    ends = np.searchsorted(row, np.arange(len(column) + 1))
    return [distinct(found[a:b]) for a, b in zip(ends, ends[1:])]


def _common_ranges(docs: DataFrame, words: int) -> np.ndarray:
    """How common each of 2**COMMON_BITS ranges of the hash is: 0, or the binary logarithm of its documents.

    It only decides the order of shingles, so tasks report just the ranges that stand out in their rows.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COMMON_BITS, np.int64)
        for batch in batches:
            sets = text_sets(batch.column("text"), words)
            total += np.bincount((np.concatenate(sets) >> np.uint64(64 - COMMON_BITS)).astype(np.int64), minlength=1 << COMMON_BITS)
        out = np.flatnonzero(total >= max(COMMON_LEAST, COMMON_TIMES * total.mean()))
        yield table(range=pa.array(out, pa.int64()), n=pa.array(total[out], pa.int64()))

    found = over_texts(docs, counted, "range long, n long").groupBy("range").agg(F.sum("n").alias("n")).collect()
    common = np.zeros(1 << COMMON_BITS, np.uint8)
    for r in found:
        common[r["range"]] = r["n"].bit_length()
    return common


def _sketches(docs: DataFrame, words: int, percent: int, common: np.ndarray) -> DataFrame:
    """One row per document: size, digest of the set, its first shingles as keys, its point."""
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = text_sets(batch.column("text"), words)
            yield table(doc_id=batch.column("doc_id"), n=pa.array([len(s) for s in sets], pa.int64()),
                        digest=blobs([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]),
                        keys=blobs([first_shingles(s, common, percent).tobytes() if len(s) else b"" for s in sets]),
                        point=blobs([point(s).tobytes() for s in sets]))

    return over_texts(docs, sketched, "doc_id long, n long, digest binary, keys binary, point binary")


def _star(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each key, keys, a, b): every other set of a key with the key's smallest."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    low = doc[np.flatnonzero(new)[np.cumsum(new) - 1]]
    some = low != doc
    return order[new], key[some], low[some], doc[some]


def _stars(firsts: DataFrame) -> DataFrame:
    """(key, a, b): the cells of more than one set, each other set of a cell with a smaller one of it.

    Keys travel packed. Sets of one batch that share a key are joined to the smallest of them there,
    which alone goes on, so that a key most sets share costs one entry per batch. The pairs found
    there travel in equal parts with all buckets of the batch.
    """
    keys_in = firsts.agg((F.sum(F.octet_length("keys")) / 8).cast("long")).first()[0] or 0
    buckets = max(1, -(-keys_in // BUCKET_KEYS))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                raw = batch.column("keys").to_pylist()
                key = np.frombuffer(b"".join(raw), np.uint64)
                doc = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(r) // 8 for r in raw])
                if not len(key):
                    continue
                kept, *pairs = _star(key, doc)
                key, doc = key[kept], doc[kept]
                bucket = ((key >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                key, doc, bucket = key[order], doc[order], bucket[order]
                at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                ends = [*at[1:], len(key)]
                yield table(bucket=pa.array(bucket[at], pa.int64()), keys=blobs([key[i:j].tobytes() for i, j in zip(at, ends)]),
                            docs=blobs([doc[i:j].tobytes() for i, j in zip(at, ends)]),
                            **{n: blobs([p.tobytes() for p in np.array_split(pair, len(at))]) for n, pair in zip("kab", pairs)})

    def met(group):
        keys, docs, *before = (np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in (
            ("keys", np.uint64), ("docs", np.int64), ("k", np.uint64), ("a", np.int64), ("b", np.int64)))
        k, a, b = (np.concatenate(pair) for pair in zip(before, _star(keys, docs)[1:]))
        return pa.table({"key": k.view(np.int64), "a": a, "b": b})

    packed = firsts.select("doc_id", "keys").mapInArrow(spread, "bucket long, keys binary, docs binary, k binary, a binary, b binary")
    return packed.groupBy("bucket").applyInArrow(met, "key long, a long, b long")


def _bounded(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, good): whether sizes and points of rows (a, b, na, nb, pa, pb) allow the similarity."""
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 4000) for i in range(0, whole.num_rows, 4000)):
                na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
                most = np.minimum(points(batch.column("pa").to_pylist()), points(batch.column("pb").to_pylist())).sum(axis=1)
                yield table(a=batch.column("a"), b=batch.column("b"), good=pa.array(most >= needed(na, nb, percent)))

    return pairs.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(judged, "a long, b long, good boolean")


def _cell_forest(percent: int):
    """A function that joins the points of each cell whose bound allows the similarity, with as few pairs as do it."""
    def forest(group):
        key, doc, n = (group.column(c).to_numpy() for c in ("key", "doc_id", "n"))
        vectors = points(group.column("point").to_pylist())
        order = np.lexsort((doc, key))
        key, doc, n, vectors = key[order], doc[order], n[order], vectors[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        a, b = [], []
        for lo, hi in zip(at, [*at[1:], len(key)]):
            above = list(range(hi - lo))

            def root(x: int) -> int:
                while above[x] != x:
                    above[x] = x = above[above[x]]
                return x

            tree = CountTree(vectors[lo:hi], n[lo:hi])
            for i in range(hi - lo):
                for j in tree.search(vectors[lo + i], n[lo + i], percent):
                    x, y = root(i), root(int(j))
                    if x != y:
                        above[max(x, y)] = min(x, y)
            joined = [(root(i), i) for i in range(hi - lo) if root(i) != i]  # with the smallest of those it hangs together with
            a += [doc[lo + i] for i, _ in joined]
            b += [doc[lo + i] for _, i in joined]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return forest


def _families(sketches: DataFrame, percent: int) -> DataFrame:
    """(doc_id, family) of the sets that a chain of pairs within the bound connects with others of their cells."""
    stars = cut(_stars(sketches))
    places = sketches.select("doc_id", "n", "point")
    involved = cut(places.join(_few(stars.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()), "doc_id", "left_semi"))
    end = lambda c: involved.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}"))
    judged = cut(_bounded(stars.select("a", "b").distinct().join(end("a"), "a").join(end("b"), "b"), percent))
    # Cells that their smallest set does not hold together are searched.
    loose = stars.join(judged.where("not good"), ["a", "b"], "left_semi").select("key").distinct()
    cells = cut(stars.join(loose, "key", "left_semi").groupBy("key").agg(F.count("*").alias("pairs")).where("pairs > 1"))
    blocks = F.ceil(F.col("pairs") / CELL_MEMBERS).cast("int")
    members = stars.join(cells.select("key", blocks.alias("blocks")), "key").select("key", "blocks", F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    members = cut(members.join(involved, "doc_id"))
    tasks = members.count() // CELL_ROWS + 1
    small = members.where("blocks = 1").withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks))).withColumn("other", F.lit(-1))
    # A large cell is searched by every two of its blocks.
    block, every = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    large = members.where("blocks > 1").withColumn("block", block).withColumn("with", F.explode(every)).where("block <> with")
    large = large.withColumn("task", F.xxhash64("key", F.least("block", "with"))).withColumn("other", F.greatest("block", "with"))
    columns = ["task", "other", "key", "doc_id", "n", "point"]
    found = small.select(*columns).union(large.select(*columns)).groupBy("task", "other").applyInArrow(_cell_forest(percent), "a long, b long")
    pairs = judged.where("good").select("a", "b").union(found)
    return components(pairs).select(F.col("node").alias("doc_id"), F.col("component").alias("family"))


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of rows (a, b, sa, sb) whose sets are linked."""
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return pairs.where(common * (100 + percent) >= (F.size("sa") + F.size("sb")).cast("long") * percent).select("a", "b")


def _fine_points(rows: DataFrame, percent: int) -> DataFrame:
    """The rows with n and the point of their size class in place of the shingles."""
    kept = [f for f in rows.schema.fields if f.name != "shingles"]

    def pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                sets = [s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in batch.column("shingles")]
                groups = [fine_groups(c, percent) for c in batch.column("size").to_pylist()]
                yield table(**{f.name: batch.column(f.name) for f in kept}, n=pa.array([len(s) for s in sets], pa.int64()),
                            point=blobs([point(s, g).tobytes() for s, g in zip(sets, groups)]))

    return rows.mapInArrow(pointed, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", n long, point binary")


def _surviving(percent: int):
    """A function that finds the strays and others of different parts whose points allow the similarity, by the blocks in which they meet.

    The R-tree holds the points summed to GROUPS groups; what it returns is held against the finer points.
    """
    def surviving(group):
        family, size = group.column("family")[0].as_py(), group.column("size")[0].as_py()
        doc, part, block, n, stray = (group.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "part", "block", "n", "stray"))
        stray = stray.astype(bool)
        groups = fine_groups(size, percent)
        fine = points(group.column("point").to_pylist(), groups)
        rough = fine.reshape(len(doc), GROUPS, groups // GROUPS).sum(axis=2, dtype=np.int32)
        others, met = np.flatnonzero(~stray), np.zeros((len(doc), WIDE), bool)  # row x block of the other side, of which WIDE are here
        tree = CountTree(rough[others], n[others]) if len(others) else None
        for i in np.flatnonzero(stray) if len(others) else ():
            near = others[tree.search(rough[i], n[i], percent)]
            near = near[part[near] != part[i]]
            near = near[np.minimum(fine[near], fine[i]).sum(axis=1) >= needed(n[near], n[i], percent)]
            met[i, block[near] % WIDE] = True
            met[near, block[i] % WIDE] = True
        row, at = np.nonzero(met)
        mine, wide = block[row], {c: group.column(c)[0].as_py() * WIDE for c in ("wide_i", "wide_j")}
        return pa.table({"family": pa.array([family] * len(row), pa.int64()), "size": pa.array([size] * len(row), pa.int32()),
                         "doc_id": pa.array(doc[row], pa.int64()), "part": pa.array(part[row], pa.int64()), "stray": pa.array(stray[row]),
                         "i": pa.array(np.where(stray[row], mine, wide["wide_i"] + at), pa.int32()),
                         "j": pa.array(np.where(stray[row], wide["wide_j"] + at, mine), pa.int32())})

    return surviving


def _searching(percent: int):
    """A function that connects the parts of a family that links between its strays and other sets connect.

    An R-tree returns the sets within the bound of a stray, and these are verified on their shingles.
    """
    def searched(group):
        doc, stray, part = (group.column(c).to_pylist() for c in ("doc_id", "stray", "part"))
        above, raw = {p: p for p in part}, group.column("shingles").combine_chunks()
        ends, flat = raw.offsets.to_numpy(), raw.values.to_numpy(zero_copy_only=False).view(np.uint64)
        sets = [flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

        def root(x: int) -> int:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        others = [i for i in range(len(doc)) if not stray[i]]
        if len(others) in (0, len(doc)):  # blocks are dealt by hash, and some are empty
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        sizes = np.array([len(sets[i]) for i in others])
        vectors = points([point(s).tobytes() for s in sets])
        tree = CountTree(vectors[others], sizes)
        # Shingle -> those who have it, to verify a stray against all that its search returns at once.
        shingle, owner = np.concatenate([sets[i] for i in others]), np.repeat(np.arange(len(others), dtype=np.int32), sizes)
        order = np.argsort(shingle, kind="stable")
        shingle, owner = shingle[order], owner[order]
        for i in (i for i in range(len(doc)) if stray[i]):
            near = tree.search(vectors[i], len(sets[i]), percent)
            lo, hi = np.searchsorted(shingle, sets[i], side="left"), np.searchsorted(shingle, sets[i], side="right")
            at = np.arange((hi - lo).sum()) + np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo)
            common = np.bincount(owner[at], minlength=len(others))[near]
            for j in near[common >= needed(sizes[near], len(sets[i]), percent)].tolist():
                mine, other = root(part[i]), root(part[others[j]])
                if mine != other:
                    above[max(mine, other)] = min(mine, other)
        joined = [(root(p), p) for p in above if root(p) != p]  # parts are named after one of their sets
        return pa.table({"a": pa.array([a for a, _ in joined], pa.int64()), "b": pa.array([b for _, b in joined], pa.int64())})

    return searched


def _few(ids: DataFrame) -> DataFrame:
    """Marked for broadcasting when it was counted to be small; joined by shuffling otherwise."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _member_sets(docs: DataFrame, families: DataFrame, words: int) -> DataFrame:
    """(doc_id, family, n, shingles) of the documents in families."""
    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = text_sets(batch.column("text"), words)
            yield table(doc_id=batch.column("doc_id"), family=batch.column("family"), n=pa.array([len(s) for s in sets], pa.int64()),
                        shingles=pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())))

    rows = docs.join(_few(families), "doc_id")
    return cut(over_texts(rows, spelled, "doc_id long, family long, n long, shingles array<long>", more={"family": F.col("family")}))


def _links(docs: DataFrame, families: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that connect whatever is connected within the families."""
    sets = _member_sets(docs, families, words)
    names = sets.select("doc_id", "family", "n")

    def parted(links: DataFrame) -> DataFrame:
        """(doc_id, family, n, part): what is connected so far, named after its smallest set."""
        labels = components(links)
        found = names.join(labels, names["doc_id"] == labels["node"], "left")
        return cut(found.select("doc_id", "family", "n", F.coalesce("component", "doc_id").alias("part")))

    def with_heads(heads: DataFrame, wanted: DataFrame) -> DataFrame:
        """Links between sets and the heads of their family."""
        heads = sets.join(_few(heads), "doc_id", "left_semi").select("family", F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        pairs = wanted.select("family", F.col("doc_id").alias("b"), F.col("shingles").alias("sb")).join(heads, "family").where("a <> b")
        return cut(_verified(pairs, percent))

    links = with_heads(names.where("doc_id = family").select("doc_id"), sets)
    members = parted(links)
    # Families that their smallest set does not settle get further heads, so that few sets are left to search for.
    rest = members.where("part <> family")
    draw = Window.partitionBy("family").orderBy(F.xxhash64("doc_id"), "doc_id")
    heads = cut(rest.withColumn("draw", F.row_number().over(draw)).where(F.col("draw") <= HEADS).select("doc_id", "family"))
    unsettled = sets.join(_few(heads.select("family").distinct()), "family", "left_semi")
    links = links.union(with_heads(heads.select("doc_id"), unsettled))
    members = parted(links)
    sizes = members.groupBy("family", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("family").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    members = cut(members.join(main, "family"))
    # Sizes in classes that grow by the ratio of partners' sizes or a little more: partners are in the same or the next class.
    size = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100.1 / percent))).cast("int")
    near = F.explode(F.array(*[F.col("size") + i for i in (-1, 0, 1)]))
    sized = members.withColumn("size", size)
    blocks = F.ceil(F.sum(F.greatest("n", F.lit(GROUPS))) / BLOCK_SHINGLES).cast("int")
    strays_in = sized.where("part <> main").withColumn("size", near).groupBy("family", "size").agg(blocks.alias("stray_blocks"))
    open_families = cut(sized.groupBy("family", "size").agg(blocks.alias("blocks")).join(strays_in, ["family", "size"]))
    if not open_families.limit(1).count():
        return links
    at = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int").alias("block")
    wide = lambda n: (F.ceil(F.col(n) / WIDE) - 1).cast("int").alias("last")
    row = ["family", "size", "doc_id", "part"]
    strays = sized.where("part <> main").withColumn("size", near).join(open_families, ["family", "size"])
    others = sized.join(open_families, ["family", "size"])
    # Who takes part is settled on ids alone; the sets are read once and not shuffled, only their points are.
    roles = cut(strays.select(*row, F.lit(True).alias("stray"), at("stray_blocks"), wide("blocks")).union(
        others.select(*row, F.lit(False).alias("stray"), at("blocks"), wide("stray_blocks"))))
    pointed = _fine_points(sets.select("doc_id", "shingles").join(_few(roles), "doc_id"), percent)
    own, every = F.floor(F.col("block") / WIDE).cast("int"), F.explode(F.sequence(F.lit(0), F.col("last")))
    meeting = pointed.withColumn("other", every).withColumn("wide_i", F.when(F.col("stray"), own).otherwise(F.col("other"))).withColumn(
        "wide_j", F.when(F.col("stray"), F.col("other")).otherwise(own))
    survivors = cut(meeting.groupBy("family", "size", "wide_i", "wide_j").applyInArrow(
        _surviving(percent), "family long, size int, doc_id long, part long, stray boolean, i int, j int"))
    found = sets.select("doc_id", "shingles").join(_few(survivors), "doc_id").groupBy("family", "size", "i", "j").applyInArrow(
        _searching(percent), "a long, b long")
    return links.union(found)


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Words are runs of other than space and the control characters 9 to 13, A-Z in lower case; the set
    of a document is its distinct shingles of ``words`` words, or its whole sequence where it has
    fewer. Documents link when 100 * intersection >= ``percent`` * union; ``component_id`` is the
    smallest id reachable by links, the document's own included. Documents without words or text
    have no shingles and link with nothing. Rows with a null id take no part and have a null
    component; rows of one id are one node that all their texts link. An empty table gives an empty
    result. Shingles are compared by 64-bit hashes. Other columns are ignored.
    """
    plain = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    sketches = cut(_sketches(plain, words, percent, _common_ranges(plain, words)))
    firsts = cut(sketches.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")))
    # Copies of a set have the same keys; the one of the smallest id stands for all.
    alone = sketches.where("n > 0").join(_few(firsts), ["digest", "doc_id"], "left_semi")
    labels = components(_links(plain, _families(alone, percent), words, percent))
    labelled = firsts.join(labels, firsts["doc_id"] == labels["node"], "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component_id"))
    whole = sketches.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(labelled, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
