"""Periodic runs of words by internal pattern matching.

A run with smallest period q is a longest stretch in which words q apart are equal. Its first period
contains a block whose length is a power of two and which starts at a multiple of half that length, and
q words later the run holds the block again. So every block asks where it occurs in the window next
to it: its occurrences are an interval of the suffix array, and a wavelet tree over the suffix array
gives those in the window in order (range successor). Occurrences that overlap form a progression,
of which the first difference is the only candidate period; the query then goes on beyond the stretch that
the progression fills. Candidates are extended to both sides by longest common extensions, read
from the ranks that prefix doubling leaves at each power of two.

Words are numbered per document, so the documents of a slice are worked on as one sequence in which
nothing repeats across documents. All steps are array operations, and their work is at most
proportional to n log(n)**2 for n words, however periodic these are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.arrow import over_texts, table
from shelfwise.llm.vocab import byte_texts

LEAST = 12  # words of the shortest run
_FIRST = 2  # blocks of four words: every run of 12 words holds one twice
_CHUNK = 1 << 20

_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixRanks:
    """Prefix doubling over a sequence: ``levels[k]`` ranks the pieces of 2**k words, equal ones alike.

    A rank is the place where the suffixes beginning with that piece start in the suffix array, so
    a piece's occurrences are ``array[rank : rank + ties]``.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        order = np.argsort(words, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = _starts(words[order])
        self.levels, self.blocks, span = [], {}, 1
        while True:
            ties = np.bincount(rank, minlength=n)[rank]
            tied = np.flatnonzero(ties > 1)
            if not len(tied):
                break
            level = len(self.levels)
            self.levels.append(np.append(rank, -1).astype(np.int32))
            if level >= _FIRST:
                at = tied[tied % (span // 2) == 0]
                self.blocks[level] = at, rank[at], rank[at] + ties[at]
            follows = tied + span
            following = np.where(follows < n, rank[np.minimum(follows, n - 1)] + 1, 0)
            key = rank[tied] * (n + 1) + following
            by_key = np.argsort(key, kind="stable")
            old, new = rank[tied][by_key], key[by_key]
            rank[tied[by_key]] = old + _starts(new) - _starts(old)
            span *= 2
        self.array = np.empty(n, np.int64)
        self.array[rank] = np.arange(n)

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are equal; i < j."""
        at, to = i.copy(), j.copy()
        for k in reversed(range(len(self.levels))):
            step = (self.levels[k][at] == self.levels[k][to]).astype(np.int64) << k
            at += step
            to += step
        return at - i

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are equal; i < j."""
        at, to = i.copy(), j.copy()
        for k in reversed(range(len(self.levels))):
            fits = at >= 1 << k
            same = self.levels[k][np.where(fits, at - (1 << k), 0)] == self.levels[k][np.where(fits, to - (1 << k), 0)]
            step = (fits & same).astype(np.int64) << k
            at -= step
            to -= step
        return i - at


def _starts(values: np.ndarray) -> np.ndarray:
    """Of sorted values: for each the index of the first one equal to it."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


class WaveletTree:
    """Wavelet tree, level by level, over numbers below their count; answers many queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, len(values).bit_length())
        self.zeros = []  # per level: zero bits before each place, and in all
        for bit in reversed(range(self.bits)):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of values[lo:hi] are below the bound, itself at most the count of all values."""
        found = np.zeros(len(lo), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            one = (bound >> bit & 1).astype(bool)
            lo0, hi0 = zeros[lo], zeros[hi]
            found += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, zeros[-1] + lo - lo0, lo0), np.where(one, zeros[-1] + hi - hi0, hi0)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest, from 0, of values[lo:hi]."""
        found = np.zeros(len(lo), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            lo0, hi0 = zeros[lo], zeros[hi]
            one = nth >= hi0 - lo0
            nth = np.where(one, nth - (hi0 - lo0), nth)
            found += one.astype(np.int64) << bit
            lo, hi = np.where(one, zeros[-1] + lo - lo0, lo0), np.where(one, zeros[-1] + hi - hi0, hi0)
        return found


def _candidates(ranks: SuffixRanks, tree: WaveletTree, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) pairs whose blocks of 2**level words are equal, for the periods this level is there for."""
    n, size = len(ranks.array), 1 << level
    least, most = (1 if level == _FIRST else size * 3 // 2 - 1), size * 3 - 2
    at, lo, hi = ranks.blocks[level]
    upto = tree.below(lo, hi, np.minimum(at + most + 1, n))
    nth = tree.below(lo, hi, at + 1)
    some = upto > nth
    at, lo, hi, upto, nth = (x[some] for x in (at, lo, hi, upto, nth))
    if not len(at):
        return
    first = tree.smallest(lo, hi, nth) - at
    yield at[first >= least], first[first >= least]
    # Where the next occurrence overlaps, all up to the end of its progression are multiples of it.
    goal = at + np.maximum(least, first + 1)
    over = np.flatnonzero(first <= size)
    end = at[over] + first[over] + ranks.after(at[over], at[over] + first[over])
    goal[over] = np.maximum(goal[over], end - size + 1)
    nth = tree.below(lo, hi, np.minimum(goal, n))
    more = np.maximum(upto - nth, 0)
    total = np.cumsum(more)
    for part in range(0, int(total[-1]), _CHUNK):
        each = np.arange(part, min(part + _CHUNK, int(total[-1])))
        block = np.searchsorted(total, each, side="right")
        place = nth[block] + each - (total[block] - more[block])
        yield at[block], tree.smallest(lo[block], hi[block], place) - at[block]


def runs_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of at least 12 words and two periods, by start, then period."""
    ranks, found = SuffixRanks(words), []
    if ranks.blocks:
        tree = WaveletTree(ranks.array)
        for level in ranks.blocks:
            for at, period in _candidates(ranks, tree, level):
                start = at - ranks.before(at, at + period)
                end = at + period + ranks.after(at, at + period)
                run = end - start >= np.maximum(LEAST, 2 * period)
                # Blocks of one run give it many times over; shorter periods come first.
                found.append(np.unique(np.stack([start[run], end[run], period[run]]), axis=1))
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort([period, end, start])
    start, end, period = start[order], end[order], period[order]
    # A stretch found with several periods has the shortest; the others are its multiples.
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort([period, start])
    return start[order], (end - start)[order], period[order]


def _repeating(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Rows in which four words occur twice, and perhaps some more; no other row has a run."""
    if len(words) < 4:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        w = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        w ^= w >> np.uint64(29)
        mixed = w[:-3] + w[1:-2] * np.uint64(0xBF58476D1CE4E5B9) + w[2:-1] * np.uint64(0x94D049BB133111EB) + w[3:] * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9FB21C651E98DF25)
    bits = np.uint64(max(1, int(row[-1]).bit_length()))
    keyed = np.sort((mixed >> bits << bits) | row[:-3].astype(np.uint64))
    return np.unique(keyed[1:][keyed[1:] == keyed[:-1]] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _numbered(words: list[bytes], base: int) -> np.ndarray:
    """The words as numbers from ``base`` on, equal words alike."""
    number = {w: base + i for i, w in enumerate(set(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _runs_of_rows(rows: list[list[bytes]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row -> its runs, for the rows that have some."""
    size = np.array([len(words) for words in rows])
    base, numbers = 0, []
    for words in rows:
        numbers.append(_numbered(words, base))
        base += len(words)
    if not base:
        return {}
    kept = _repeating(np.concatenate(numbers), np.repeat(np.arange(len(rows)), size))
    if not len(kept):
        return {}
    begins = np.concatenate([[0], np.cumsum(size[kept])])
    start, length, period = runs_of(np.concatenate([numbers[r] for r in kept]))
    owner = np.searchsorted(begins, start, side="right") - 1
    edges = np.searchsorted(owner, np.arange(len(kept) + 1))
    return {
        int(r): (start[a:b] - begins[i], length[a:b], period[a:b])
        for i, (r, a, b) in enumerate(zip(kept, edges[:-1], edges[1:])) if b > a
    }


def _kept_words(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def word_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of each whole text, and the text without their repeats.

    Words are what stands between white space (space, tab to carriage return), as it is written. ``runs``
    has every run as (start, length, period) in words, by start, then period; ``collapsed`` joins by one
    space the words that no run contains after its first period. A null text counts as empty: no words,
    no runs, an empty ``collapsed``. Rows are worked on one for one, so repeated and null ids come back
    as often as they are there; an empty table gives an empty result; other columns are ignored. Texts
    are never cut: memory is some 400 bytes a word of the longest text in which four words recur.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [t.split() for t in byte_texts(batch.column("text"))]  # bytes: splits at just these six characters
            by_row = _runs_of_rows(rows)
            collapsed = [b" ".join(_kept_words(words, *by_row[r]) if r in by_row else words) for r, words in enumerate(rows)]
            runs = [[dict(zip(("start", "length", "period"), run)) for run in zip(*(x.tolist() for x in by_row[r]))] if r in by_row else []
                    for r in range(len(rows))]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield table(doc_id=batch.column("doc_id"), n_words=pa.array([len(w) for w in rows], pa.int64()),
                        runs=pa.array(runs, kind), collapsed=pa.array([c.decode() for c in collapsed], pa.string()))

    return over_texts(docs, found, _SCHEMA, id, text)
