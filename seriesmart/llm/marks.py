"""Which documents a later step needs, as marks of hashed ids in a table of fixed size.

A marked id may be another with the same hash, so the step joins by id after all; but texts that
nobody needs are neither hashed nor shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesmart.llm.common import map_arrow

#: Size of the table, and the tasks that make it.
MARK_BITS = 24
MARK_TASKS = 8


def mark_of(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = np.zeros(1 << MARK_BITS, bool)
    for batch in batches:
        marks[mark_of(batch.column(0).to_numpy())] = True
    packed = zlib.compress(np.packbits(marks).tobytes(), 1)
    yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["marks"])


def marks_of(ids: DataFrame) -> np.ndarray:
    """Which hashes of ids occur: a table of fixed size (2 MB) that spares texts a shuffle."""
    found = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    for row in map_arrow(ids.repartition(MARK_TASKS), _mark, "marks binary").collect():
        found |= np.frombuffer(zlib.decompress(row.marks), np.uint8)
    return found


def marked_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose first column, an id, is among `ids`, and a few more."""
    marks = rows.sparkSession.sparkContext.broadcast(marks_of(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(marks.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(marked[mark_of(batch.column(0).to_numpy())]))

    return map_arrow(rows, run, rows.schema)
