"""Merkle manifest of a dataset: a tree of every group of rows, a tree over those, a witness for each row.

H is the lowercase hex sha256 of its inputs' concatenation; digests enter as hex text. The leaves of a
tree stand in order; while several nodes remain, every `FAN` consecutive ones become their H (the last
run may be shorter, even one node). What remains is the tree's root.

Witnesses are incremental. A task takes an aligned block of leaves as a stream and appends each to the
open subtrees, one per level; a leaf enters with an empty witness, and whenever a run completes, the
witnesses below each of its nodes are extended by that node's siblings. The roots of blocks are
appends of the next round, in blocks of their own, until every tree has one node. On the way back the
witness of a block's root, then whole, extends those of its block. Rounds are few (a block spans
`BLOCK` nodes) and a task holds one block, however large a group is.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seriesmart.llm.common import map_arrow, partitions, stored
from seriesmart.llm.prefix import group_key

FAN = 16
#: Levels and nodes of the subtree that one task builds at a time.
LEVELS = 3
BLOCK = FAN**LEVELS
#: Rows of a batch that goes back to Spark: a witness has about a KB a level.
BATCH = 512

STEPS = T.ArrayType(
    T.StructType([T.StructField("left", T.StringType(), False), T.StructField("right", T.StringType(), False)]), False
)


# --- Digests, as columns -------------------------------------------------------------------------


def field(column: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """H of the columns of a row."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def fold(digest: Column, steps: Column) -> Column:
    """The root that a leaf has with the siblings of a witness."""
    return F.aggregate(steps, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """H of all siblings of a witness, from the leaf up and left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


# --- Open subtrees -------------------------------------------------------------------------------


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


class OpenSubtrees:
    """The open run of nodes of each level, with the witnesses of the leaves below each node."""

    def __init__(self, levels: int):
        self.open: list[list[tuple[str, list[list]]]] = [[] for _ in range(levels)]
        self.root = ""

    def append(self, digest: str, witness: list | None = None) -> None:
        """The next leaf; `witness`, if given, is extended as its subtrees complete."""
        self._put(0, digest, [] if witness is None else [witness])

    def _put(self, level: int, digest: str, below: list[list]) -> None:
        if level == len(self.open):
            self.root = digest
            return
        run = self.open[level]
        run.append((digest, below))
        if len(run) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        for i, (_, below) in enumerate(run):
            if below:
                step = ("".join(digests[:i]), "".join(digests[i + 1 :]))
                for witness in below:
                    witness.append(step)
        self._put(level + 1, sha256("".join(digests).encode()).hexdigest(), [w for _, b in run for w in b])

    def close(self) -> str:
        """Complete the runs that are still open; the root of the block."""
        for level, run in enumerate(self.open):
            if run:
                self._complete(level)
        return self.root


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


# --- Spark ---------------------------------------------------------------------------------------


def placed(spark: SparkSession, leaves: DataFrame, order: list[str]) -> DataFrame:
    """`leaves` (tree, digest, ...) with `pos`, the place in the tree by `order` and digest, and its size `n`.

    Ranges of the whole order are sorted apart, so no tree goes through one task; equal leaves, which
    may stand in any order, are split by a random key. A leaf's place is its row in the range plus the
    tree's leaves in earlier ranges.
    """
    by = [F.col("tree"), *map(F.col, order), F.col("digest"), F.rand(11)]
    ranges = leaves.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by[:-1])
    at = F.monotonically_increasing_id()  # the range and the row in it
    rows = stored(spark, ranges.select("*", F.shiftright(at, 33).alias("range"), at.alias("at")), "leaves")
    each = Window.partitionBy("tree")
    before = each.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("m"))
    base = counts.select(
        "tree",
        "range",
        (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("m").over(each).alias("n"),
    )
    found = rows.join(base, ["tree", "range"])
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("range", "at", "shift")


def _by_block(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Blocks whole and in order; a block's root, if there, before its nodes."""
    return nodes.repartition(partitions(spark), "tree", "block").sortWithinPartitions("tree", "block", "pos")


def rounds(spark: SparkSession, leaves: DataFrame) -> list[DataFrame]:
    """Nodes (tree, n, pos, digest) of every round: the leaves, the roots of their blocks, and so on to the roots."""
    most = leaves.agg(F.max("n")).first()[0] or 1
    found = [leaves]
    while most > 1:
        nodes = found[-1].select("tree", "n", "pos", "digest").withColumn("block", F.floor(F.col("pos") / BLOCK))
        found.append(stored(spark, map_arrow(_by_block(spark, nodes), _block_roots, ROOTS), "roots"))
        most = -(-most // BLOCK)
    return found


ROOTS = "tree string, n long, pos long, digest string"


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, made = ["tree", "n", "pos", "digest"], []
    for (tree, n, block), rows in groupby(_rows(batches, ["tree", "n", "block", "digest"]), lambda r: r[:3]):
        subtrees = OpenSubtrees(min(LEVELS, height(n)))
        for row in rows:
            subtrees.append(row[3])
        made.append((tree, -(-n // BLOCK), block, subtrees.close()))
        if len(made) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=names)
            made = []
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=names)


def witnesses(spark: SparkSession, found: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with `steps`, `subroot` and `root`.

    `found` are the `rounds` of the trees and `tops` has (tree, steps, subroot, root) of each tree's root.
    """
    above = tops.withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(found[:-1] if len(found) > 1 else found):
        given = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
        heads = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "steps", "subroot", "root")
        both = _by_block(spark, heads.unionByName(given, allowMissingColumns=True))
        kept = [f for f in nodes.schema.fields if f.name not in ("tree", "pos")]
        schema = T.StructType(
            [
                T.StructField("tree", T.StringType()),
                T.StructField("pos", T.LongType()),
                *kept,
                T.StructField("steps", STEPS),
                T.StructField("subroot", T.StringType()),
                T.StructField("root", T.StringType()),
            ]
        )
        above = map_arrow(both, _extend(schema), schema)
        if nodes is not found[0]:
            above = stored(spark, above.select("tree", "pos", "steps", "subroot", "root"), "witnesses")
    return above


def _extend(schema: T.StructType):
    """Blocks as streams: first the witness of the block's root, then its nodes in order."""
    names = schema.names
    shape = to_arrow_schema(schema)
    payload = [n for n in names if n not in ("steps", "subroot", "root")]
    size, digest = payload.index("n"), payload.index("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _rows(batches, ["tree", "block", "pos", "steps", "subroot", "root", *payload])
        for _, rows in groupby(read, lambda r: r[:2]):
            _, _, place, steps, subroot, root, *_ = next(rows)
            if place != -1:
                raise ValueError("a block without the witness of its root")
            head = [(s["left"], s["right"]) for s in steps]
            held, subtrees = [], None
            for row in rows:
                values = row[6:]
                subtrees = subtrees or OpenSubtrees(min(LEVELS, height(values[size])))
                held.append((values, witness := []))
                subtrees.append(values[digest], witness)
            if subtrees is None:
                continue
            subtrees.close()
            for a in range(0, len(held), BATCH):
                part = held[a : a + BATCH]
                columns = [pa.array(c, shape.field(n).type) for n, c in zip(payload, zip(*[v for v, _ in part]))]
                columns.append(_steps([w + head for _, w in part], shape.field("steps").type))
                columns += [pa.array([x] * len(part), pa.string()) for x in (subroot, root)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _steps(found: list[list[tuple[str, str]]], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int32)
    flat = [step for w in found for step in w]
    sides = [pa.array([s[k] for s in flat], pa.string()) for k in (0, 1)]
    pairs = pa.StructArray.from_arrays(sides, fields=list(kind.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets), pairs, type=kind)


def manifest(spark: SparkSession, rows: DataFrame, group: str, order: list[str], digest: str) -> DataFrame:
    """`rows` with `leaf`, `steps` (the witness), `subroot` and `root`.

    `digest` names the column of leaf digests, `group` the column whose values have a tree each (null
    has one too), `order` the columns that order a tree's leaves, nulls first; leaves that agree in them
    stand in order of their digest. The trees' roots are leaves of the root's tree in order of the group,
    null first and else bytewise. Repeated rows are leaves of their own. An empty table stays empty.
    Columns `leaf`, `steps`, `subroot` and `root` are replaced, all others pass through under any name.
    """
    made = ["leaf", "steps", "subroot", "root"]
    others = [c for c in rows.columns if c not in made and c != digest]
    names = {c: f"c{i}" for i, c in enumerate(others)}
    given = rows.select(
        *[F.col(f"`{c}`").alias(a) for c, a in names.items()],
        F.col(f"`{digest}`").alias("digest"),
        group_key(F.col(f"`{group}`")).alias("tree"),
    )
    leaves = stored(spark, placed(spark, stored(spark, given, "digests"), [names[c] for c in order]), "placed")
    trees = rounds(spark, leaves)
    subroots = trees[-1].select(F.col("tree").alias("name"), F.lit("").alias("tree"), "digest")
    top = rounds(spark, stored(spark, placed(spark, subroots, ["name"]), "subroots"))
    nothing = F.array().cast(STEPS)
    root = top[-1].select("tree", nothing.alias("steps"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    tops = witnesses(spark, top, root).select(
        F.col("name").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"
    )
    found = witnesses(spark, trees, stored(spark, tops, "tops"))
    return found.select(
        *[F.col(a).alias(c) for c, a in names.items()], F.col("digest").alias("leaf"), "steps", "subroot", "root"
    )
