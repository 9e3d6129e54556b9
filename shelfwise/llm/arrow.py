"""Running a function over the (id, text) rows of a table in bounded Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.texts import row_slices, text_bytes


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about a megabyte of text or one longer row."""
    for batch in batches:
        offsets, _ = text_bytes(batch.column(column))
        for lo, hi in row_slices(offsets):
            yield batch.slice(lo, hi - lo)


def over_texts(docs: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
               id: str = "doc_id", text: str = "text", more: dict | None = None) -> DataFrame:
    """``function`` over batches with the columns ``doc_id``, ``text`` and ``more`` (name -> column).

    Only these columns are read, so others of any name neither cost a scan nor clash.
    """
    picked = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"),
                         *[c.alias(n) for n, c in (more or {}).items()])
    return picked.mapInArrow(lambda batches: function(sliced(batches)), schema)


def table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def long_values(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)
