"""Token-id files in canonical length-limited Huffman code.

A file set is two Parquet tables below one folder, so that it lives on any file system Spark writes
to and is committed task by task:

* ``lengths``: (id, length), the bits of each id's code. Canonical codes follow from these alone:
  ids in order of (length, id) get consecutive codes.
* ``blocks``: one row per block of whole documents in ascending id order: shard, block, start (ids
  of the shard before it), doc_ids, counts (ids of each document), checkpoints (bit offset of every CHECKPOINT-th id of a document,
  its first included, and of the next documents' likewise) and payload. A document begins at a byte.

Blocks are decoded without each other, all checkpoints of a block side by side: a table of the
code's first bits gives id and length of the next id of every run at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.storage import cut, scratch_path
from shelfwise.llm.arrow import blobs, over_texts, table
from shelfwise.llm.vocab import byte_texts, token_ids

CHECKPOINT = 256
BLOCK_IDS = 1 << 18
MAX_BITS = 16
MAX_SHARDS = 20_000
SHARD_ROWS = 4096
BLOCKS = "shard long, block long, start long, doc_ids array<long>, counts array<long>, checkpoints array<long>, payload binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each id (0: unused) of the best code with at most ``limit`` bits, by package-merge.

    Raised where the ids in use do not fit into ``limit`` bits.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    level, leaves = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        joined = np.concatenate([weights, pairs])
        order = np.argsort(joined, kind="stable")
        level = joined[order]
        leaves.append(order < n)
    take = 2 * n - 2
    for is_leaf in reversed(leaves):
        chosen = int(is_leaf[:take].sum())
        lengths[used[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


@dataclass
class Code:
    """Codes and the decoding table of an array of lengths."""

    lengths: np.ndarray

    def __post_init__(self):
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        sizes = self.lengths[order].astype(np.int64)
        self.bits = bits = int(sizes[-1]) if len(sizes) else 1
        room = np.int64(1) << (bits - sizes)  # table entries that begin with the code
        begin = np.cumsum(room) - room
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[order] = (begin >> (bits - sizes)).astype(np.uint64)
        self.symbol = np.zeros(1 << bits, np.uint32)
        self.symbol[: int(room.sum())] = np.repeat(order, room)
        self.advance = self.lengths[self.symbol].astype(np.int64)

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Documents of ``counts`` ids each, every one from a byte on.

        Returns their bytes, the byte at which each begins, the checkpoints as bit offsets within their
        document, and how many each document has.
        """
        size = self.lengths[ids].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        first = np.cumsum(counts) - counts
        bits = total[first + counts] - total[first]
        begin = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
        within = total[:-1] - np.repeat(total[first], counts)
        at = within + np.repeat(8 * begin[:-1], counts)
        # Codes of at most 32 bits touch two 32-bit words; sums of disjoint bits are exact in doubles.
        placed = self.codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
        word, words = at >> 5, (8 * int(begin[-1]) + 31) // 32 + 1
        packed = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), words)
        packed += np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)[:words]
        points = np.flatnonzero((np.arange(len(ids)) - np.repeat(first, counts)) % CHECKPOINT == 0)
        return packed.astype(">u4").tobytes()[: int(begin[-1])], begin, within[points], -(-counts // CHECKPOINT)

    def decode(self, payload: bytes, counts: np.ndarray, checkpoints: np.ndarray) -> np.ndarray:
        """The ids of a block's documents, one after the other."""
        runs = -(-counts // CHECKPOINT)
        n = np.full(int(runs.sum()), CHECKPOINT, np.int64)
        n[np.cumsum(runs) - 1] = counts - (runs - 1) * CHECKPOINT
        place = np.cumsum(n) - n
        ids = np.empty(int(n.sum()), np.uint32)
        order = np.argsort(-n, kind="stable")  # the runs still going are the first ones
        n, place, at = n[order], place[order], checkpoints[order].astype(np.int64)
        raw = np.frombuffer(payload + bytes(8), np.uint8)
        # The 32 bits that begin at each byte.
        windows = np.zeros(len(raw) - 3, np.uint32)
        for i in range(4):
            windows |= raw[i : len(raw) - 3 + i].astype(np.uint32) << np.uint32(24 - 8 * i)
        mask, drop = (1 << self.bits) - 1, 32 - self.bits
        going = np.searchsorted(-n, -np.arange(CHECKPOINT), side="left")
        for step in range(int(n[0]) if len(n) else 0):
            k = int(going[step])
            some = at[:k]
            index = (windows[some >> 3].astype(np.int64) >> (drop - (some & 7))) & mask
            ids[place[:k] + step] = self.symbol[index]
            some += self.advance[index]
        return ids


def _packed_ids(ids: np.ndarray) -> bytes:
    """Ids in bytes by plane, squeezed, for the table between the two passes."""
    planes = ids.view(np.uint8).reshape(-1, 4).T
    used = 4 if planes[2:].any() else 2
    return bytes([used]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:used]).tobytes())


def _unpacked_ids(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    return np.ascontiguousarray(planes.T).view(np.uint16 if blob[0] == 2 else np.uint32).ravel()


def _shard_bounds(docs: DataFrame, id: str) -> list[int]:
    rows = docs.select(F.count("*")).first()[0]
    shards = min(MAX_SHARDS, rows // SHARD_ROWS + 1)
    if shards < 2:
        return []
    cuts = docs.select(docs[id].cast("long").alias("k")).agg(
        F.percentile_approx("k", [i / shards for i in range(1, shards)], 100 * shards)).first()[0]
    return sorted(set(cuts or []))


def write_ids(docs: DataFrame, vocabulary: str, path: str, end: int = 0, id: str = "doc_id", text: str = "text") -> None:
    """Encodes every whole text, each with id ``end`` after it, into a file set at ``path``.

    Null and empty texts hold the end id alone; documents of equal id follow each other, null ids
    come first; other columns are ignored; an empty table makes a file set without blocks.
    """
    spark, bounds = docs.sparkSession, np.array(_shard_bounds(docs, id), np.int64)

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per batch with its documents, and one at the end with the counts of all ids of the task."""
        tail, total = np.array([end], np.uint32).tobytes(), np.zeros(0, np.int64)
        for batch in batches:
            each = token_ids(vocabulary, byte_texts(batch.column("text")))
            ids = np.frombuffer(tail.join([*each, b""]), np.uint32)
            some = np.bincount(ids)
            if len(some) > len(total):
                total = np.concatenate([total, np.zeros(len(some) - len(total), np.int64)])
            total[: len(some)] += some
            yield table(doc_ids=pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        counts=pa.array([[len(x) // 4 + 1 for x in each]], pa.list_(pa.int64())), ids=blobs([_packed_ids(ids)]))
        used = np.flatnonzero(total)
        yield table(doc_ids=pa.array([used], pa.list_(pa.int64())), counts=pa.array([total[used]], pa.list_(pa.int64())), ids=pa.array([None], pa.binary()))

    rows = cut(over_texts(docs, tokenised, "doc_ids array<long>, counts array<long>, ids binary", id, text))
    # At most one row per id of the vocabulary reaches the driver.
    pairs = rows.where("ids is null").select(F.inline(F.arrays_zip(F.col("doc_ids").alias("id"), F.col("counts").alias("n"))))
    counts = pairs.groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(max((r["id"] for r in counts), default=0) + 1, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    lengths = code_lengths(total)
    pairs = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(pairs, "id long, length int").coalesce(1).write.parquet(f"{path}/lengths")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for whole in batches:
            for row in range(whole.num_rows):
                doc_ids, n, blob = (whole.column(c)[row] for c in ("doc_ids", "counts", "ids"))
                doc_ids, n = doc_ids.values, n.values.to_numpy(zero_copy_only=False)
                payload, begin, points, runs = code.encode(_unpacked_ids(blob.as_py()), n)
                ends = np.concatenate([[0], np.cumsum(runs)])
                shard = np.searchsorted(bounds, doc_ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="left")
                yield table(shard=pa.array(shard, pa.int64()), doc_id=doc_ids, n=pa.array(n, pa.int64()),
                            checkpoints=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(points, pa.int64())),
                            payload=blobs([payload[a:b] for a, b in zip(begin, begin[1:])]))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_ids, shard, number, start = [], 0, None, 0, 0

        def block() -> pa.RecordBatch:
            points, at = [], 0
            for _, _, some, payload in held:
                points.append(np.asarray(some, np.int64) + 8 * at)
                at += len(payload)
            return table(shard=pa.array([shard], pa.int64()), block=pa.array([number], pa.int64()),
                         start=pa.array([start], pa.int64()), doc_ids=pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                         counts=pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                         checkpoints=pa.array([np.concatenate(points)], pa.list_(pa.int64())), payload=blobs([b"".join(h[3] for h in held)]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "doc_id", "n", "payload")]
            for s, doc, n, payload, some in zip(*columns, batch.column("checkpoints")):
                if held and (s != shard or held_ids + n > BLOCK_IDS):
                    yield block()
                    number, start = (number + 1, start + held_ids) if s == shard else (0, 0)
                    held, held_ids = [], 0
                shard = s
                held.append((doc, n, some.values.to_numpy(zero_copy_only=False), payload))
                held_ids += n
        if held:
            yield block()

    ordered = rows.where("ids is not null").mapInArrow(encoded, "shard long, doc_id long, n long, checkpoints array<long>, payload binary")
    ordered = ordered.repartition("shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "n", "payload")
    ordered.mapInArrow(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a file set, decoded from it.

    ``start`` counts the ids of all documents before, in the order of the file set.
    """
    pairs = spark.read.parquet(f"{path}/lengths").collect()  # one row per id of the vocabulary
    lengths = np.zeros(max((r["id"] for r in pairs), default=0) + 1, np.uint8)
    for r in pairs:
        lengths[r["id"]] = r["length"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per shard, at most MAX_SHARDS of them.
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = blocks.select("shard", n.alias("n")).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    base, total = {}, 0
    for r in sorted(sizes):
        base[r["shard"]] = total
        total += r["n"]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for whole in batches:
            for i in range(whole.num_rows):
                batch = whole.slice(i, 1)
                shard, start, payload = (batch.column(c)[0].as_py() for c in ("shard", "start", "payload"))
                doc_ids, counts, points = (batch.column(c)[0].values for c in ("doc_ids", "counts", "checkpoints"))
                counts, points = counts.to_numpy(zero_copy_only=False), points.to_numpy(zero_copy_only=False)
                raw = memoryview(code.decode(payload, counts, points).tobytes())
                ends = np.cumsum(counts)
                sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts.tolist(), ends.tolist())]
                yield table(doc_id=doc_ids, start=pa.array(base[shard] + start + ends - counts, pa.int64()),
                            n_tokens=pa.array(counts, pa.int64()), ids_crc32=pa.array(sums, pa.int64()))

    return blocks.mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids_crc32 long")
