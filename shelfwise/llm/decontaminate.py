"""Benchmark passages in training documents, by BM25 over an inverted index with block-max WAND.

The index holds the test items, cut into segments of at most SEGMENT words. Its terms are word pairs:
single words of a passage this long occur in most items, and a bound over them rules nothing out.
Every document is read
as passages of 2 * SEGMENT words, one beginning every SEGMENT words, so that a copied segment lies
within one passage whole. A passage is a query; the score of a segment is its BM25 score as a share
of what the segment scores for itself. Segments are in blocks, and the largest share a term can add
in a block is known: one array pass bounds all passages of a batch for all blocks, and WAND runs only
for those that may reach the threshold in some block. Segments serve retrieval only: the whole
question and the whole answer of an item are then verified on word pairs, gathered over all passages
of the document that were retrieved for the item, with the words around them that the rest of the item
would take up. A side of fewer than FEW words is verified on its words too, near what is found of the
other side.

The items are indexed in shards of bounded size, each sent to all tasks once; corpus statistics of
the items are those of all shards.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.arrow import over_texts, sliced, table
from shelfwise.llm.texts import ALPHANUMERIC, Words, combined, distinct, text_bytes
from shelfwise.llm.toxicity import _lower

SEGMENT = 48
BLOCKS = 16
SHARD_ITEMS = 5_000
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.5, 0.5
FEW = 4  # sides of fewer words are verified on single words too
NEAR = 8  # words that may stand between a side that short and the other side
_SENTENCE_END = re.compile(r"[.!?]\s+|\n+")
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]")


def question_and_answer(text: str) -> tuple[str, str]:
    """The text before its last sentence with words, and the rest; of one sentence, the last third of its words."""
    text = text.strip()
    for end in reversed([m.end() for m in _SENTENCE_END.finditer(text)]):
        if _WORD.search(text, end):
            if _WORD.search(text, 0, end):
                return text[:end], text[end:]
            break
    words = text.split()
    worded = [i for i, w in enumerate(words) if _WORD.search(w)]
    cut = worded[-max(1, len(worded) // 3)] if worded else len(words)
    return " ".join(words[:cut]), " ".join(words[cut:])


def _words_of(texts: list[str]) -> Words:
    return Words(*text_bytes(_lower(pa.array(texts, pa.string()))), ALPHANUMERIC)


def pairs_of(hashes: np.ndarray) -> np.ndarray:
    """The word pairs of a run of words, in reading order."""
    return combined([hashes[:-1], hashes[1:]]) if len(hashes) > 1 else np.empty(0, np.uint64)


def occurrences(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """How often each of the values occurs in ``among``."""
    among = np.sort(among)
    return np.searchsorted(among, values, side="right") - np.searchsorted(among, values, side="left")


class Side:
    """Question or answer of an item: the distinct word pairs, of a side of few words the words too, and how often the other side has each."""

    def __init__(self, words: np.ndarray, other: np.ndarray):
        self.size, self.few = len(words), len(words) < FEW
        self.pairs = pairs_of(words)
        self.own = distinct(np.concatenate([words, self.pairs]) if self.few else self.pairs)
        self.elsewhere = occurrences(self.own, np.concatenate([other, pairs_of(other)]))

    def share(self, present: np.ndarray) -> float:
        """Share of what the side is made of that ``present`` holds beyond the other side's; 1 for a side without words."""
        return float((occurrences(self.own, present) > self.elsewhere).mean()) if len(self.own) else 1.0


class Item:
    """An item's number of words and its two sides."""

    def __init__(self, question: np.ndarray, answer: np.ndarray):
        self.size, self.sides = len(question) + len(answer), (Side(question, answer), Side(answer, question))

    def overlaps(self, words: np.ndarray, spans: list[tuple[int, int]]) -> tuple[float, float]:
        """Shares of the question and of the answer in the spans of a row's words."""
        merged: list[list[int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        at = np.concatenate([np.arange(a, b) for a, b in merged])
        first = at[:-1][np.diff(at) == 1]
        word, pair = words[at], combined([words[first], words[first + 1]])
        shares = []
        for side, other in (self.sides, self.sides[::-1]):
            near, begins = np.ones(len(at), bool), np.ones(len(first), bool)
            if side.few and len(other.pairs):
                found = first[np.isin(pair, other.pairs)]
                reach = NEAR + side.size
                close = lambda x, found=found, reach=reach: np.searchsorted(found, x - reach - 1) < np.searchsorted(found, x + reach, side="right")
                near, begins = close(at), close(first)
            shares.append(side.share(np.concatenate([word[near], pair[begins]]) if side.few else pair))
        return shares[0], shares[1]


class Segments:
    """The segments of some items: item, place in the item, distinct terms with counts, lengths; the items with both sides."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.begin, self.terms, self.length, self.place, self.items = [], [], [], [], [], []
        for item, text in items:
            parts = _words_of(list(question_and_answer(text or "")))
            border, h = int(parts.first[1]), parts.hash
            pieces = -(-len(h) // SEGMENT)
            for i in range(pieces):
                a, b = i * len(h) // pieces, (i + 1) * len(h) // pieces
                if b - a < 2:
                    continue
                self.item.append(item)
                self.begin.append(a)
                self.terms.append(np.unique(combined([h[a : b - 1], h[a + 1 : b]]), return_counts=True))
                self.length.append(b - a)
                self.place.append(len(self.items))
            self.items.append(Item(h[:border], h[border:]))


class Index:
    """Impacts by term and segment, with the largest by term and block."""

    def __init__(self, segments: Segments, document_counts: dict[int, int], n: int, mean_length: float):
        """``document_counts``, ``n`` and ``mean_length`` are those of the segments of all shards."""
        self.segments, count = segments, len(segments.item)
        self.item_of = dict(zip(segments.place, segments.item))
        term = np.concatenate([t for t, _ in segments.terms])
        times = np.concatenate([c for _, c in segments.terms]).astype(float)
        segment = np.repeat(np.arange(count), [len(t) for t, _ in segments.terms])
        known = np.array([document_counts[int(t)] for t in term], float)
        length = np.array(segments.length, float)[segment]
        impact = np.log1p((n - known + 0.5) / (known + 0.5)) * times * (K1 + 1) / (times + K1 * (1 - B + B * length / mean_length))
        impact /= np.bincount(segment, impact, count)[segment]
        order = np.lexsort((segment, term))
        self.vocabulary, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(term))
        self.segment, self.impact = segment[order], impact[order]
        self.width = -(-count // BLOCKS)
        self.block_max = np.zeros((len(self.vocabulary), BLOCKS))
        of = np.repeat(np.arange(len(self.vocabulary)), np.diff(self.first))
        np.maximum.at(self.block_max, (of, self.segment // self.width), self.impact)
        self.term_max = self.block_max.max(axis=1)
        self.near = np.zeros(1 << 20, bool)  # most pairs of a corpus are ruled out by their first bits
        self.near[self.vocabulary >> np.uint64(44)] = True

    def term_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, terms) of the word pairs that occur in the index."""
        at = np.flatnonzero(self.near[hashes >> np.uint64(44)])
        found = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        good = self.vocabulary[found] == hashes[at]
        return at[good], found[good]

    def wand(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(segment, score) of every segment that scores at least ``threshold`` for the distinct ``terms``."""
        slack = threshold - 1e-9
        lists = [[self.segment[self.first[t] : self.first[t + 1]].tolist(), self.impact[self.first[t] : self.first[t + 1]].tolist(),
                  float(self.term_max[t]), self.block_max[t].tolist(), 0] for t in terms]
        out = []
        while True:
            lists = [x for x in lists if x[4] < len(x[0])]
            lists.sort(key=lambda x: x[0][x[4]])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[2]
                if bound >= slack:
                    pivot = x[0][x[4]]
                    break
            if pivot is None:
                return out
            block = pivot // self.width
            within = [x for x in lists if x[0][x[4]] <= pivot]
            if sum(x[3][block] for x in within) < slack:
                # No segment up to the block's end, or to where the next list begins, can score enough.
                to = min((block + 1) * self.width, min((x[0][x[4]] for x in lists[len(within) :]), default=1 << 60))
                for x in within:
                    x[4] = bisect_left(x[0], to, x[4])
            elif within[0][0][within[0][4]] == pivot:
                total = sum(x[1][x[4]] for x in within)
                if total >= slack:
                    out.append((pivot, total))
                for x in within:
                    x[4] += 1
            else:
                for x in within:
                    x[4] = bisect_left(x[0], pivot, x[4])

    def matches(self, words: Words, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) of each row and item whose sides both reach ``overlap``."""
        pair = np.flatnonzero(words.row[:-1] == words.row[1:])
        at, term = self.term_of(combined([words.hash[pair], words.hash[pair + 1]])) if len(pair) else (pair, pair)
        at = pair[at]
        # Half passages: SEGMENT words of one row, numbered through all rows.
        counts = np.diff(words.first)
        halves = -(-counts // SEGMENT)
        first_half = np.cumsum(halves) - halves
        half = first_half[words.row[at]] + (at - words.first[words.row[at]]) // SEGMENT
        key = distinct(half * len(self.vocabulary) + term)
        half, term = key // len(self.vocabulary), key % len(self.vocabulary)
        total = int(halves.sum())
        if not len(half):
            return []
        starts = np.searchsorted(half, np.arange(total + 1))
        bound = np.zeros((total + 1, BLOCKS))
        filled = np.flatnonzero(np.diff(starts))
        bound[filled] = np.add.reduceat(self.block_max[term], starts[filled], axis=0)
        row_of = np.repeat(np.arange(len(counts)), halves)
        follows = np.append(row_of[1:] == row_of[:-1], False)  # the next half is of the same row
        bound = bound[:-1] + np.where(follows[:, None], bound[1:], 0)
        # (row, place of the item) -> best score, and the spans in which the whole item may stand.
        retrieved: dict[tuple[int, int], list] = {}
        for i in np.flatnonzero((bound >= threshold - 1e-9).any(axis=1)):
            to = i + 2 if follows[i] else i + 1
            found = self.wand(distinct(term[starts[i] : starts[to]]), threshold)
            row = int(row_of[i])
            begin = int(i - first_half[row]) * SEGMENT
            for segment, score in found:
                place, size = self.segments.place[segment], int(counts[row])
                before, after = self.segments.begin[segment], self.segments.items[place].size - self.segments.begin[segment] - self.segments.length[segment]
                span = max(0, begin - before), min(begin + int(to - i) * SEGMENT + after, size)
                entry = retrieved.setdefault((row, place), [0.0, []])
                entry[0] = max(entry[0], min(score, 1.0))
                entry[1].append(span)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for (row, place), (score, spans) in retrieved.items():
            shares = self.segments.items[place].overlaps(words.hash[words.first[row] : words.first[row + 1]], spans)
            if min(shares) >= overlap:
                key = row, self.item_of[place]
                best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, *shares))
        return [(*k, *v) for k, v in sorted(best.items())]


def build(items: DataFrame, id: str = "item_id", text: str = "text", shard_items: int = SHARD_ITEMS) -> list[Index]:
    """One index per shard of at most about ``shard_items`` items; items of fewer than two words or without id are left out."""
    plain = items.select(items[id].cast("long").alias("item_id"), items[text].cast("string").alias("text")).where("item_id is not null and text is not null")
    shards = -(-plain.count() // shard_items)
    shard = F.pmod(F.xxhash64("item_id"), F.lit(max(1, shards)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = Segments(list(zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())))
            for terms, _ in segments.terms:
                yield table(term=pa.array(terms.view(np.int64)), length=pa.array(np.zeros(len(terms), np.int64)))
            yield table(term=pa.array([None] * len(segments.length), pa.int64()), length=pa.array(segments.length, pa.int64()))

    out = []
    counts = plain.mapInArrow(counted, "term long, length long").groupBy("term").agg(F.count("*").alias("n"), F.sum("length").alias("length"))
    whole = counts.where("term is null").first()
    for k in range(shards):
        segments = Segments(sorted((r["item_id"], r["text"]) for r in plain.where(shard == k).collect()))
        if not segments.item:
            continue
        own = distinct(np.concatenate([t for t, _ in segments.terms])).view(np.int64)
        terms = items.sparkSession.createDataFrame(pa.table({"term": own}))
        known = {r["term"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in counts.join(F.broadcast(terms), "term").collect()}
        out.append(Index(segments, known, whole["n"], whole["length"] / whole["n"]))
    return out


def contaminated(docs: DataFrame, indexes: list[Index], threshold: float = THRESHOLD, overlap: float = OVERLAP, id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap), one row per document and item found in it.

    ``score`` is the best share of the item's own BM25 score among the document's passages, from
    ``threshold`` to 1; the overlaps are shares of the whole question's and the whole answer's word pairs
    in all passages retrieved for the item (of sides of fewer than FEW words, of words and pairs), and both
    have to reach ``overlap``. Null and empty texts contain nothing; rows of one id are
    reported each; no items, or no documents, give an empty result; other columns are ignored.
    """
    def search(index: Index):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = Words(*text_bytes(_lower(batch.column("text"))), ALPHANUMERIC)
                if rows := index.matches(words, threshold, overlap):
                    row, item, score, question, answer = zip(*rows)
                    yield table(doc_id=batch.column("doc_id").take(pa.array(row)), item_id=pa.array(item, pa.int64()), score=pa.array(score),
                                question_overlap=pa.array(question), answer_overlap=pa.array(answer))

        return over_texts(docs, found, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double", id, text)

    parts = [search(index) for index in indexes]
    if not parts:
        return docs.select(docs[id].cast("long").alias("doc_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("item_id", "long"), ("score", "double"), ("question_overlap", "double"), ("answer_overlap", "double"))]).where("false")
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def without_contaminated(docs: DataFrame, indexes: list[Index], threshold: float = THRESHOLD, overlap: float = OVERLAP,
                         text: str = "text") -> DataFrame:
    """The rows, with all their columns, in which no item is found."""
    def clean(index: Index):
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, text):
                good = np.ones(batch.num_rows, bool)
                words = Words(*text_bytes(_lower(batch.column(text))), ALPHANUMERIC)
                good[[r[0] for r in index.matches(words, threshold, overlap)]] = False
                yield batch.filter(pa.array(good))

        return kept

    for index in indexes:
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs
