"""Texts of Arrow batches as numpy arrays of word hashes.

Everything works on the UTF-8 bytes of a slice of rows at once. A word's hash is its polynomial in
an odd base modulo 2**64, taken from one running sum per slice and mixed afterwards, so the cost is
a few array operations per byte whatever the words are. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []

# White space as the contracts define words: space and the control characters 9 to 13.
_byte = np.arange(256)
NOT_SPACE = ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13)))
# Letters, digits and everything beyond ASCII.
ALPHANUMERIC = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint64) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power_tables(size: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            table = np.full(max(size, SLICE_BYTES) + 1, factor, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[:] = tables
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def row_slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one row that is longer."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


class Words:
    """The words of some rows: ``row`` (from 0), ``start``, ``end`` (bytes) and ``hash``, in reading order."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, kind: np.ndarray):
        self.bounds = offsets - offsets[0]
        self.data = data = data[offsets[0] : offsets[-1]]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind[data]
        edge = np.zeros(len(data) + 1, bool)  # a row begins here
        edge[self.bounds] = True
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        self.row = np.searchsorted(self.bounds, self.start, side="right") - 1
        power, inverse = _power_tables(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(LOWER[data] * power[: len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])
        # Words of a row: first[row] up to first[row + 1].
        self.first = np.searchsorted(self.row, np.arange(len(self.bounds)))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def combined(hashes: list[np.ndarray]) -> np.ndarray:
    """Hash of the sequence made of one entry of each array."""
    total = np.full(len(hashes[0]), len(hashes), np.uint64)
    for i, h in enumerate(hashes):
        total = total + h * np.uint64((_BASE * (2 * i + 3)) % (1 << 64) | 1)
    return mix(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a row of fewer words has its whole sequence as one."""
    count = len(words.hash)
    whole = np.flatnonzero(words.row[: count - size + 1] == words.row[size - 1 :]) if count >= size else np.empty(0, np.int64)
    rows, found = [words.row[whole]], [combined([words.hash[whole + i] for i in range(size)])]
    n = np.diff(words.first)
    for short in range(1, size):
        at = np.flatnonzero(n == short)
        if len(at):
            rows.append(at)
            found.append(combined([words.hash[words.first[at] + i] for i in range(short)]))
    row, found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return row[order], found[order]
