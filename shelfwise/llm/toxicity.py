"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are presences of single words, word pairs and pairs with one or two words between, hashed
into 2**BITS coordinates. Every coordinate has its own learning rate, and the L1 term keeps most
weights at exactly zero, so the model is a short list that is sent to all tasks. It is fitted in
one task on a bounded sample of the labelled rows; scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.arrow import blobs, over_texts, sliced, table
from shelfwise.llm.texts import ALPHANUMERIC, Words, combined, distinct, text_bytes

BITS = 20
SAMPLE = 12_000  # labelled documents the model is fitted on, at most about
EPOCHS, ALPHA, BETA, L1, L2 = 6, 1.0, 1.0, 2.0, 0.5
THRESHOLD = 0.7
# Distance between the two words of a pair, and what tells it from the other distances.
_GAP_MARKS = {1: np.uint64(0), 2: np.uint64(0x5851F42D4C957F2D), 3: np.uint64(0x14057B7EF767814F)}


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, coordinate) arrays, one pair for the words and one for each gap."""
    shift, h = np.uint64(64 - BITS), words.hash
    yield words.row, (h >> shift).astype(np.int64)
    for gap in _GAP_MARKS:
        at = np.flatnonzero(words.row[:-gap] == words.row[gap:]) if len(h) > gap else np.empty(0, np.int64)
        pair = combined([h[at], h[at + gap] ^ _GAP_MARKS[gap]])
        yield words.row[at], (pair >> shift).astype(np.int64)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string()))


@dataclass
class ToxicityModel:
    """Non-zero weights by coordinate, and the bias."""

    coordinates: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.coordinates] = self.weights
        return out

    def scores(self, column: pa.Array, dense: np.ndarray) -> np.ndarray:
        """Probabilities for a column of texts; each coordinate of a text counts once."""
        words = Words(*text_bytes(_lower(column)), ALPHANUMERIC)
        found = []
        for row, at in features(words):
            some = np.flatnonzero(dense[at])
            found.append((row[some] << BITS) | at[some])
        once = distinct(np.concatenate(found))
        total = np.bincount(once >> BITS, dense[once & ((1 << BITS) - 1)], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def ftrl(coordinates: np.ndarray, ends: np.ndarray, labels: np.ndarray) -> ToxicityModel:
    """FTRL-proximal over examples, passed EPOCHS times in the order given.

    Example i has the coordinates from ends[i] up to ends[i + 1].
    """
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)  # the last coordinate is the bias
    free = 1 << BITS

    def weights(at: np.ndarray) -> np.ndarray:
        some = z[at]
        l1 = np.where(at == free, 0.0, L1)
        return np.where(np.abs(some) <= l1, 0.0, -(some - np.sign(some) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for a, b, label in zip(ends.tolist(), ends[1:].tolist(), labels.tolist()):
            at = np.append(coordinates[a:b].astype(np.int64), free)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            step = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient * gradient
    w = weights(np.arange(free + 1))
    used = np.flatnonzero(w[:free])
    return ToxicityModel(used, w[used], float(w[free]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, sample: int = SAMPLE,
        id: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Fits on about ``sample`` of the labelled rows that ``learn``, a condition on ``id``, allows.

    Rows with a null id or label are left out, of several labels of one id the larger holds; without
    any labelled row the model scores 0.5 everywhere.
    """
    known = labels.select(labels[id].alias("doc_id"), labels[label].cast("int").alias("y")).where("doc_id is not null and y is not null")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    part = min(1.0, sample / max(1, known.count()))
    order = F.xxhash64("doc_id")
    chosen = known.where(F.pmod(order, F.lit(1_000_000)) < round(part * 1_000_000))
    texts = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")  # bounded by ``sample``

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(*text_bytes(_lower(batch.column("text"))), ALPHANUMERIC)
            once = distinct(np.concatenate([(row << BITS) | at for row, at in features(words)]))
            ends = np.searchsorted(once >> BITS, np.arange(batch.num_rows + 1))
            at = (once & ((1 << BITS) - 1)).astype(np.uint32)
            yield table(place=batch.column("place"), y=batch.column("y"), at=blobs([at[a:b].tobytes() for a, b in zip(ends, ends[1:])]))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).sort_by("place")
        ends = np.cumsum([0, *pc.binary_length(rows.column("at")).to_pylist()]) // 4
        model = ftrl(np.frombuffer(b"".join(rows.column("at").to_pylist()), np.uint32), ends, rows.column("y").to_numpy())
        yield table(at=blobs([model.coordinates.tobytes()]), w=blobs([model.weights.tobytes()]), bias=pa.array([model.bias]))

    prepared = over_texts(rows, extracted, "place long, y int, at binary", "doc_id", "text", {"place": order, "y": F.col("y")})
    found = prepared.repartition(1).mapInArrow(fitted, "at binary, w binary, bias double").collect()
    if not found:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), 0.0)
    return ToxicityModel(np.frombuffer(found[0]["at"], np.int64), np.frombuffer(found[0]["w"], np.float64), found[0]["bias"])


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text.

    Null and empty texts get the score of the bias alone; rows are kept one for one; other columns
    are ignored.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = model.dense()
        for batch in batches:
            found = model.scores(batch.column("text"), dense)
            yield table(doc_id=batch.column("doc_id"), score=pa.array(found, pa.float64()),
                        predicted=pa.array((found >= threshold).astype(np.int32), pa.int32()))

    return over_texts(docs, scored, "doc_id long, score double, predicted int", id, text)


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below ``threshold``."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = model.dense()
        for batch in sliced(batches, text):
            yield batch.filter(pa.array(model.scores(batch.column(text), dense) < threshold))

    return docs.mapInArrow(kept, docs.schema)
