"""Product codes of vectors by Lloyd's rounds over cover trees.

Vectors are cut into equal parts and each part has a codebook of few entries. A task takes its vectors
in blocks and builds one cover tree for each part of a block: a node covers its points within a radius,
its children do so within half of it and their centres stand further apart than that. Points lie in the
order of the tree, so a node's points are a range and cumulative sums give their sum at once. In a round
a node whose nearest entry stays the nearest by the triangle inequality for everything within its
radius is assigned whole; only ambiguous nodes descend, and leaves that still are compare exactly.

Trees are written once and read in every round. A round sends one row for each part, entry and
component from each task; the driver holds nothing but the codebooks.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesmart.llm.common import map_arrow, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a tree at most.
BLOCK = 8192
#: Points of a node that is not cut further.
LEAF = 16
#: Integer components are cut off here, so that squared distances are exact in 64 bits.
LARGEST = 1 << 24


class Tree(NamedTuple):
    """A cover tree: points in its order, and nodes as arrays, children behind their parents.

    Node i covers points `low[i]` to `high[i]`, has its centre at `low[i]` and the squared radius
    `reach[i]`; its children are nodes `first[i]` to `first[i] + children[i]`, none for a leaf.
    """

    points: np.ndarray
    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    reach: np.ndarray
    first: np.ndarray
    children: np.ndarray

    def dump(self) -> bytes:
        np.savez(out := io.BytesIO(), *self)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(*arrays.values())


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of points, exact."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def build(points: np.ndarray) -> Tree:
    """The tree of one point or more; a node's centre is also that of its first child."""
    order = np.arange(len(points))
    low, high, reach, first, children = [0], [len(points)], [0], [0], [0]
    i = -1
    while (i := i + 1) < len(low):  # breadth first: children are appended
        a, b = low[i], high[i]
        own = order[a:b]
        far = squared(points[own], points[own[0]])
        reach[i] = int(far.max())
        if b - a <= LEAF or not reach[i]:
            continue
        first[i], at, rest, far_rest = len(low), a, own, far
        while len(rest):
            inside = 4 * far_rest <= reach[i]  # within half of the radius
            members, rest = rest[inside], rest[~inside]
            order[at : at + len(members)] = members
            low.append(at)
            at += len(members)
            high.append(at)
            for column in (reach, first, children):
                column.append(0)
            children[i] += 1
            if len(rest):
                far_rest = squared(points[rest], points[rest[0]])
    return Tree(points[order], order, *(np.array(c, np.int64) for c in (low, high, reach, first, children)))


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)


class Assignment:
    """Entries of all points of a tree, whole subtrees at a time."""

    def __init__(self, tree: Tree, entries: np.ndarray):
        self.compared = 0  # points and centres compared with the entries
        points = tree.points.astype(np.int64)
        running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])
        self.labels = np.zeros(len(points), np.uint8)
        self.sums = np.zeros_like(entries)
        self.counts = np.zeros(len(entries), np.int64)
        nodes = np.zeros(1, np.int64)
        while len(nodes):
            low, high = tree.low[nodes], tree.high[nodes]
            entry, sure = self._nearest(points[low], entries, tree.reach[nodes])
            a, b, e = low[sure], high[sure], entry[sure]
            self.labels[_spread(a, b)] = np.repeat(e, b - a)
            np.add.at(self.sums, e, running[b] - running[a])
            np.add.at(self.counts, e, b - a)
            open_nodes = nodes[~sure]
            inner = tree.children[open_nodes] > 0
            leaves = open_nodes[~inner]
            at = _spread(tree.low[leaves], tree.high[leaves])
            entry, _ = self._nearest(points[at], entries)
            self.labels[at] = entry
            np.add.at(self.sums, entry, points[at])
            np.add.at(self.counts, entry, 1)
            inner = open_nodes[inner]
            nodes = _spread(tree.first[inner], tree.first[inner] + tree.children[inner])

    def _nearest(self, centres: np.ndarray, entries: np.ndarray, reach: np.ndarray | None = None):
        """The nearest entry of each centre, ties to the first, and whether all within reach have the same."""
        entry = np.zeros(len(centres), np.int64)
        sure = np.ones(len(centres), bool)
        for a in range(0, len(centres), 4096):
            part = slice(a, a + 4096)
            far = squared(centres[part, None, :], entries[None, :, :])
            entry[part] = far.argmin(1)
            if reach is not None and len(entries) > 1:
                least, second = np.sqrt(np.partition(far, 1, axis=1)[:, :2].astype(float)).T
                radius = np.sqrt(reach[part].astype(float))
                # Rounding of the roots is far below this margin; what it lets through is compared exactly.
                sure[part] = (reach[part] == 0) | ((least + 2 * radius) * (1 + 1e-9) + 1e-9 < second)
        self.compared += len(centres)
        return entry, sure


# --- Spark ---------------------------------------------------------------------------------------


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, cut off at plus and minus `LARGEST`."""

    def whole(x: Column) -> Column:
        return F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite."""

    def finite(x: Column) -> Column:
        value = x.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))

    return vector.isNotNull() & F.forall(vector, finite)


BLOCKS = "payload binary, trees array<binary>"


def block_trees(vectors: DataFrame, whole: str, width: int, parts: int = PARTS) -> DataFrame:
    """(payload, trees): the rows of a block without their vectors, and a tree for each part.

    Vectors shorter than `parts * width` are read as if they ended in zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(a, BLOCK)
                listed = rows.column(whole)
                sizes = listed.value_lengths().to_numpy()
                points = np.zeros((rows.num_rows, parts * width), np.int32)
                points[np.arange(parts * width) < sizes[:, None]] = listed.flatten().to_numpy()
                trees = [build(points[:, p * width : (p + 1) * width].astype(np.int64)) for p in range(parts)]
                small = [t._replace(points=t.points.astype(np.int32)).dump() for t in trees]
                kept = rows.drop_columns([whole])
                with pa.ipc.new_stream(sink := pa.BufferOutputStream(), kept.schema) as out:
                    out.write_batch(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sink.getvalue().to_pybytes()]), pa.array([small])], names=["payload", "trees"]
                )

    return map_arrow(vectors, run, BLOCKS)


def _loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[Tree]]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column("payload")[k].as_py(), [Tree.load(t) for t in batch.column("trees")[k].as_py()]


def next_codebooks(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of the mean of its parts; one without any stays."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(codebooks), np.zeros((parts, entries), np.int64)
        for _, trees in _loaded(batches):
            for p, tree in enumerate(trees):
                found = Assignment(tree, codebooks[p])
                sums[p] += found.sums
                counts[p] += found.counts
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, width)),
                pa.array(np.repeat(entry, width)),
                pa.array(np.tile(np.arange(width), len(part))),
                pa.array(sums[part, entry].ravel()),
                pa.array(np.repeat(counts[part, entry], width)),
            ],
            names=["part", "entry", "place", "total", "n"],
        )

    made = map_arrow(blocks.select("payload", "trees"), run, "part long, entry long, place long, total long, n long")
    new = codebooks.copy()
    for r in made.groupBy("part", "entry", "place").agg(F.sum("total").alias("t"), F.sum("n").alias("n")).collect():
        new[r.part, r.entry, r.place] = r.t // r.n
    return new


def codes(blocks: DataFrame, codebooks: np.ndarray, kept: T.StructType) -> DataFrame:
    """The rows of the blocks with `code` (entries in order of the parts) and `error`."""
    schema = T.StructType(
        [*kept.fields, T.StructField("code", T.ArrayType(T.IntegerType(), False)), T.StructField("error", T.LongType())]
    )
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for payload, trees in _loaded(batches):
            n = len(trees[0].order)
            code, error = np.zeros((n, len(trees)), np.int32), np.zeros(n, np.int64)
            for p, tree in enumerate(trees):
                labels = Assignment(tree, codebooks[p]).labels
                code[tree.order, p] = labels
                error[tree.order] += squared(tree.points.astype(np.int64), codebooks[p][labels])
            rows = pa.ipc.open_stream(payload).read_next_batch()
            ends = pa.array(np.arange(0, (n + 1) * len(trees), len(trees), dtype=np.int32))
            listed = pa.ListArray.from_arrays(ends, pa.array(code.ravel())).cast(shape.field("code").type)
            yield pa.RecordBatch.from_arrays([*rows.columns, listed, pa.array(error)], names=shape.names)

    return map_arrow(blocks.select("payload", "trees"), run, schema)


class Coded(NamedTuple):
    rows: DataFrame
    codebooks: np.ndarray


def compress(
    spark: SparkSession,
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Coded:
    """Rows with `code array<int>` and `error long` in place of their vector, and the codebooks.

    Rows whose vector is null or has a null or non-finite component take no part. A codebook starts as
    that part of the `entries` least ids (nulls last, ties by vector), fewer if there are fewer rows.
    Vectors of unequal length, or of one that `parts` does not divide, are read as if they ended in
    zeros. Repeated ids and rows are rows of their own. An empty table stays empty, with codebooks of
    no entry. Columns named `code` or `error` are replaced, all others pass through. `entries` is at
    most 256. Components are whole numbers, exact up to 65,536 before scaling, and cut off there.
    """
    whole = "__whole"
    kept = vectors.filter(usable(F.col(f"`{vector}`"))).withColumn(whole, whole_components(F.col(f"`{vector}`"), scale))
    kept = kept.drop(vector, "code", "error") if vec_id not in (vector, "code", "error") else kept.drop(vector)
    longest = kept.agg(F.max(F.size(whole))).first()[0] or 0
    width = max(1, -(-longest // parts))
    least = kept.select(F.col(f"`{vec_id}`").alias("i"), whole).orderBy(F.asc_nulls_last("i"), whole).limit(entries)
    first = [r[whole] for r in least.collect()]
    start = np.zeros((len(first), parts * width), np.int64)
    for row, values in zip(start, first, strict=True):
        row[: len(values)] = values
    codebooks = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    blocks = stored(spark, block_trees(kept, whole, width, parts), "trees")
    for _ in range(rounds):
        codebooks = next_codebooks(blocks, codebooks)
    shape = T.StructType([f for f in kept.schema.fields if f.name != whole])
    return Coded(stored(spark, codes(blocks, codebooks, shape), "codes"), codebooks)


def error_of_groups(rows: DataFrame, group: str, name: str) -> DataFrame:
    """`rows` with the sum of `error` over the rows of equal `group`, nulls together."""
    sums = rows.groupBy(F.col(f"`{group}`").alias("__group")).agg(F.sum("error").alias(name))
    return rows.join(sums, F.col(f"`{group}`").eqNullSafe(F.col("__group"))).drop("__group")
