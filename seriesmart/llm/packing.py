"""Best-fit decreasing packing of documents' token ids into sequences of at most `capacity` tokens.

A document's ids and its end id form one piece; only longer ones are cut, into pieces of `capacity` of
which the first takes what is left over. Pieces are placed by falling length, each into the tightest
open sequence, which a segment tree over remaining capacities finds in logarithmic time.

Best fit looks at lengths alone, so pieces of equal length are placed as one run: the run fills the
tightest sequences one after the other, exactly as its pieces would one by one. What the driver plans
thus follows from one count for each length, at most `capacity` of them, however many documents there
are; Spark tokenizes, counts, ranks the pieces of a length over all tasks and joins them with the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.llm.common import lists, map_arrow, slices, stored, texts_of
from seriesmart.llm.library_ids import unit_cache

CAPACITY = 1024


class OpenSequences:
    """Sequences by remaining capacity, as runs of consecutive numbers, under a segment tree.

    A leaf of the tree counts the sequences with that much room, a node those below it.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, first: int, count: int) -> None:
        self.runs[room].append((first, count))
        self._add(room, count)

    def take(self, room: int) -> tuple[int, int]:
        """A run of sequences with so much room."""
        first, count = self.runs[room].pop()
        self._add(room, -count)
        return first, count

    def _add(self, room: int, count: int) -> None:
        at = self.size + room
        while at:
            self.tree[at] += count
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of an open sequence that takes `length` tokens."""
        at = self.size + length
        if not self.tree[at]:
            while at > 1 and (at % 2 or not self.tree[at + 1]):  # up until there is something on the right
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.size


class Run(NamedTuple):
    """Pieces of `length` with ranks `first_rank` to `end_rank`: `each` of them to a sequence, from `sequence` on."""

    length: int
    first_rank: int
    end_rank: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best-fit decreasing for so many pieces of each length."""
    opened, runs, sequences = OpenSequences(capacity), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens")
        rank, end = 0, counts[length]
        while rank < end:
            room = opened.tightest(length)
            if room is None:
                room = capacity
                first, count = sequences, -(-(end - rank) // (capacity // length))
                sequences += count
            else:
                first, count = opened.take(room)
            each = room // length
            full = min(count, (end - rank) // each)
            rest = (end - rank) % each if full < count else 0
            for n, pieces in ((full, each), (min(rest, 1), rest)):  # filled ones, then one with the last few
                if n:
                    runs.append(Run(length, rank, rank + n * pieces, pieces, first, capacity - room))
                    if room > pieces * length:
                        opened.put(room - pieces * length, first, n)
                    rank, first, count = rank + n * pieces, first + n, count - n
            if count:
                opened.put(room, first, count)
    return runs


# --- Spark ---------------------------------------------------------------------------------------


def pieces(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 2,
    keep_ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents: (doc_id, piece, start, length, ids_crc32, part, nth), and `ids` if kept.

    `part` and `nth` number a piece among those of its length: the task that made it and its place there.
    """
    fields = [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(n, T.LongType(), False) for n in ("piece", "start", "length", "ids_crc32", "part", "nth")],
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, task = unit_cache(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, "text", 4 << 20):
                flat, counts = cache.encode_texts(texts_of(rows, "text"))
                flat = np.insert(flat, np.cumsum(counts), end_id)
                doc, piece, start, length = cut(counts + 1, capacity)
                nth = seen[length] + places(length)
                seen += np.bincount(length, minlength=capacity + 1)
                data, ends = memoryview(flat.astype("<u4").tobytes()), 4 * np.cumsum(length)
                crc = [zlib.crc32(data[e - 4 * n : e]) for e, n in zip(ends.tolist(), length.tolist())]
                made = [rows.column("doc_id").take(pa.array(doc)), *map(pa.array, (piece, start, length, crc))]
                made += [pa.array(np.full(len(doc), task)), pa.array(nth)]
                if keep_ids:
                    made.append(lists(flat.astype(np.int32), length, pa.int32()))
                yield pa.RecordBatch.from_arrays(made, names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(rows, run, T.StructType(fields))


def cut(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, first token and length of each piece of documents with so many tokens (1 or more)."""
    n = -(-counts // capacity)
    doc = np.repeat(np.arange(len(counts)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    head = (counts - (n - 1) * capacity)[doc]
    start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, head, capacity)


def places(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.searchsorted(ordered, ordered)
    return out


def assign(spark: SparkSession, made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`made` (a stored table of `pieces`) with `sequence_id` and `offset` instead of `part` and `nth`.

    The driver gets one count for each length and sends back the plan: each of at most `capacity`
    lengths ends one run, every other run uses up one of the runs of open sequences that these leave.
    """
    totals = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r.length: r.n for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = ", ".join(f"{'of_length' if f == 'length' else f} long" for f in Run._fields)
    runs = spark.createDataFrame(plan(counts, capacity), schema)
    ranked = made.join(base, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    within = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    placed = ranked.join(F.broadcast(runs), (F.col("length") == F.col("of_length")) & within)
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        *[c for c in made.columns if c not in ("part", "nth")],
        (F.col("sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("offset") + nth % F.col("each") * F.col("length")).alias("offset"),
    )


def pack(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 2,
    keep_ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece, and `ids` if kept.

    A null text counts as empty: its only token is the end id. Null and repeated ids and repeated rows
    are documents of their own. Long texts are cut, nothing is left out. An empty table gives no piece.
    Columns other than the two named are not read. Numbers of sequences go from 0 without a gap; which
    of equally long pieces stands where follows from how Spark deals out the input.
    """
    made = stored(spark, pieces(spark, docs, tokenizer, capacity, end_id, keep_ids, doc_id, text), "pieces")
    return assign(spark, made, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): each sequence whole, from pieces that kept their ids.

    A group has at most as many tokens as a sequence.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p")
    return packed.groupBy("sequence_id").agg(parts).select(
        "sequence_id",
        F.flatten("p.ids").alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.offset").alias("offsets"),
    )
