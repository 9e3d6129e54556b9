"""Token counts by byte-pair merging without identifiers.

A piece starts as one symbol per byte. Adjacent pairs wait in a heap by rank; the lowest is popped,
its two symbols become one in a doubly linked list, and the pairs with the new neighbours enter the
heap. The number of tokens is the number of symbols less the number of merges, so no vocabulary id
is looked up. Distinct chunks are merged once per task.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.arrow import over_texts, table
from shelfwise.llm.vocab import ChunkCache, byte_texts, plain_word, tokenizer


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left when no adjacent pair has a rank; ties go to the leftmost pair."""
    n = len(symbols)
    if n < 2:
        return n
    symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] is None or j == n or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two was merged meanwhile
        symbols[i] += symbols[j]
        symbols[j] = None
        left -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (rank, i))
        h = before[i]
        if h >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (rank, h))
    return left


@cache
def _counter(path: str) -> ChunkCache:
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in rules["model"]["merges"])
    ranks = {pair: i for i, pair in enumerate(pairs)}
    special = [t["content"] for t in rules["added_tokens"]]
    split = tokenizer(path).pre_tokenizer.pre_tokenize_str

    def count(chunk: bytes) -> int:
        if (word := plain_word(chunk)) is not None:
            return merged_count(word, ranks)
        parts, found = [chunk.decode()], 0
        for mark in special:  # strings of special tokens are one token each
            pieces = [p.split(mark) for p in parts]
            found += sum(len(p) - 1 for p in pieces)
            parts = [p for some in pieces for p in some]
        return found + sum(merged_count(piece, ranks) for part in parts if part for piece, _ in split(part))

    return ChunkCache(lambda ask: [count(c) for c in ask])


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text under a byte-level BPE vocabulary file.

    ``path`` is read by every worker. A null text counts as empty, with 0 bytes and 0 tokens; rows
    are kept one for one, so repeated or null ids appear as often as they come; an empty table
    gives an empty result; other columns are ignored.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            counts = [sum(v) for v in _counter(path).values(texts)]
            yield table(doc_id=batch.column("doc_id"), n_bytes=pa.array([len(t) for t in texts], pa.int64()),
                        n_tokens=pa.array(counts, pa.int64()), over_limit=pa.array([c > limit for c in counts], pa.bool_()))

    return over_texts(docs, counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", id, text)
