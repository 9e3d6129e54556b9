"""Best-fit packing of documents into sequences with a fixed number of open bins.

Every task packs the pieces of its own rows as they come, a short window of them at a time by falling
length. The free space of its open bins is a bit set, so the tightest bin for a piece is the lowest
set bit at or above the length. When a new bin is needed and all are open, the fullest closes. Bins still open when a task ends are given up and
their pieces, few per task, are packed again by rounds of wider groups until one group is left; each
group passes on as many open bins as a task at most, so no group grows with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.storage import cut
from shelfwise.llm.arrow import over_texts, table
from shelfwise.llm.vocab import byte_texts, token_ids

OPEN_BINS = 512
WINDOW = 1024  # pieces of a task that are put in order of length before they are placed
GROUP = 32  # tasks whose open bins meet in one group of the next round
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, closed boolean, part long"
_NAMES = [c.split()[0] for c in PACKED.split(", ")]


class OpenBins:
    """Online best fit; ``add`` returns the rows of a bin that had to close."""

    def __init__(self, size: int, bins: int):
        self.size, self.bins = size, bins
        self.free = 0  # bit f: a bin with f free places is open
        self.at: list[list[list]] = [[] for _ in range(size + 1)]
        self.open = 0

    def add(self, length: int, row) -> list | None:
        out, fitting = None, self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            rows = self._take(space)
        else:
            if self.open == self.bins:
                out = self.close_fullest()
            space, rows = self.size, []
        rows.append(row)
        self.at[space - length].append(rows)
        self.free |= 1 << (space - length)
        self.open += 1
        return out

    def _take(self, space: int) -> list:
        rows = self.at[space].pop()
        if not self.at[space]:
            self.free ^= 1 << space
        self.open -= 1
        return rows

    def close_fullest(self) -> list:
        return self._take((self.free & -self.free).bit_length() - 1)


def _packed(rows: Iterator[tuple], size: int, bins: int, part: int, last: bool, keep: int | None = None) -> Iterator[tuple]:
    """Rows of PACKED for rows of PIECES; full pieces and closed bins at once, open bins at the end.

    Of the bins left at the end the fullest close until ``keep`` (default: ``bins``) are open, all of
    them with ``last``.
    """
    packer, number = OpenBins(size, bins), part << 32
    keep = bins if keep is None else keep

    def closed(group: list, done: bool) -> Iterator[tuple]:
        nonlocal number
        place = 0
        for row in group:
            yield (*row, number, place, done, part)
            place += row[3]
        number += 1

    for row in rows:
        group = [row] if row[3] == size else packer.add(row[3], row)
        if group:
            yield from closed(group, True)
    while packer.open:
        group = packer.close_fullest()
        yield from closed(group, last or packer.open >= keep or sum(r[3] for r in group) == size)


def _windows(rows: Iterator[tuple]) -> Iterator[tuple]:
    while held := list(islice(rows, WINDOW)):
        yield from sorted(held, key=lambda row: -row[3])


def _batches(rows: Iterator[tuple], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in PACKED.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return table(**{n: pa.array(v, t) for n, v, t in zip(_NAMES, zip(*held), types)})

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _packing_again(size: int, bins: int, base: int, last: bool):
    """A function that packs the pieces of one group and leaves at most ``bins`` bins open.

    While it packs it needs no bound of its own: a group is the open bins of GROUP tasks.
    """
    def again(group):
        rows = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
        part = base + group.column("group")[0].as_py()
        rows = zip(*(rows.column(c).to_pylist() for c in _NAMES[:5]))
        return pa.Table.from_batches(list(_batches(_packed(rows, size, 1 << 30, part, last, bins))))

    return again


def pack(docs: DataFrame, path: str, size: int = 2048, end: int = 0, bins: int = OPEN_BINS, id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Places the token ids of every document, with id ``end`` after them, in sequences of at most ``size``.

    Returns one row per piece: doc_id, piece (from 0), start (ids of its document before it), length,
    ids_crc32 (of the piece's ids as little-endian unsigned 32-bit integers), sequence_id, offset. Only
    documents longer than ``size`` are cut, at multiples of it. Null and empty texts hold the end id
    alone; repeated rows are packed each for itself; an empty table gives an empty result; columns other
    than id and text are ignored. Pieces in a group are taken by length, id and piece, so that a
    repeated task packs alike.
    """
    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tail = np.array([end], np.uint32).tobytes()
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), token_ids(path, byte_texts(batch.column("text")))):
                ids += tail
                for i in range(0, len(ids), 4 * size):
                    some = ids[i : i + 4 * size]
                    yield doc, i // (4 * size), i // 4, len(some) // 4, zlib.crc32(some)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_packed(_windows(tokenised(batches)), size, bins, TaskContext.get().partitionId(), False))

    done = cut(over_texts(docs, first, PACKED, id, text))
    result, open_rows = done.where("closed"), done.where("not closed")
    base = 0
    while True:
        state = open_rows.agg(F.max("part").alias("last")).first()
        if state["last"] is None:
            break
        # Parts of a round are numbered beyond those before, so that no sequence number comes twice.
        groups, before, base = (state["last"] - base) // GROUP + 1, base, state["last"] + 1

        grouped = open_rows.withColumn("group", F.floor((F.col("part") - before) / GROUP).cast("long"))
        done = cut(grouped.groupBy("group").applyInArrow(_packing_again(size, bins, base, groups == 1), PACKED))
        result, open_rows = result.unionByName(done.where("closed")), done.where("not closed")
    return result.drop("closed", "part")
