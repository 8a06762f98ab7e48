"""N-gram Jaccard join by vertical partitioning, exact.

Documents with equal shingle sets are one class. Shingles have a global order, rare ones first; it comes
from counts of all documents' shingles in a table of fixed size (a collision only moves a shingle
in the order, which costs time, not links).

Candidates. Two sets that are similar enough share a shingle among the first of either, so these are
dealt by shingle. Members of one are not paired with each other: all are compared with the member whose
shingle comes earliest in its order, the most typical one. Components of the links found so far
then leave few members that may be linked to another component; those are compared with all
others of their shingle that sizes and positions do not rule out. After that no link between
different components can be missing. A member whose position leaves it no partner of its own size can only
be linked with one that has room for a larger partner, so two such members never meet: pages that share a
template but less than the limit are not paired, however many they are.

Verification. The global order is cut into fragments, ranges of it that hold equal shares of all shingles;
overlaps are counted for each fragment of a pair apart, and summed per pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmart.llm.common import map_arrow, stored
from seriesmart.llm.components import components
from seriesmart.llm.marks import mark_of, marks_of
from seriesmart.llm.shingles import WORDS, shingle_set

#: Two sets are linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Counters of shingles, in fragments of the hash order that are summed apart.
COUNTER_BITS = 22
COUNTER_FRAGMENTS = 64
#: Fragments of the global order for verification.
FRAGMENTS = 8
#: Up to so many pairs (16 MB) go to the sets; more are joined by shuffling both.
BROADCAST_PAIRS = 1_000_000


def _class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*columns], names=names)


# --- Classes and counts --------------------------------------------------------------------------

_PROFILE = "doc_id long, n_shingles long, cls long, fragment int, counts binary"


def _profiles(width: int):
    names = ["doc_id", "n_shingles", "cls", "fragment", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTER_BITS, np.int32)
        shift = np.uint64(64 - COUNTER_BITS)
        for batch in batches:
            n, classes = [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), width)
                n.append(len(found))
                classes.append(_class_of(found) if len(found) else None)
                np.add.at(counters, (found >> shift).astype(np.int64), 1)
            none = pa.nulls(len(n), pa.int32())
            yield _batch(
                names, batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(classes, pa.int64()),
                none, pa.nulls(len(n), pa.binary()),
            )
        for k, part in enumerate(np.split(counters, COUNTER_FRAGMENTS)):
            if part.any():
                void = pa.nulls(1, pa.int64())
                packed = pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())
                yield _batch(names, void, void, void, pa.array([k], pa.int32()), packed)

    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(packed.as_py()), np.int32).astype(np.int64)
            sums[k] = sums[k] + part if k in sums else part
    for k, total in sums.items():
        level = np.minimum(65535, np.round(1000 * np.log2(1 + total))).astype(np.uint16)
        yield _batch(["fragment", "level"], pa.array([k], pa.int32()), pa.array([level.tobytes()], pa.binary()))


def _rarity(spark: SparkSession, profiles: DataFrame) -> np.ndarray:
    """How frequent the shingles of each counter are: a table of fixed size (8 MB)."""
    counts = profiles.filter("fragment IS NOT NULL").select("fragment", "counts")
    dealt = counts.repartition(COUNTER_FRAGMENTS, "fragment")
    size = (1 << COUNTER_BITS) // COUNTER_FRAGMENTS
    level = np.zeros(1 << COUNTER_BITS, np.uint16)
    for row in map_arrow(dealt, _sum_counts, "fragment int, level binary").collect():
        level[row.fragment * size : (row.fragment + 1) * size] = np.frombuffer(row.level, np.uint16)
    return level


def _order_key(found: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Places of shingles in the global order: rare ones first, equally rare ones by hash."""
    rank = level[(found >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)].astype(np.uint64)
    return rank << np.uint64(48) | found >> np.uint64(16)


def _cuts(level: np.ndarray) -> np.ndarray:
    """Where the global order is cut into fragments, from how frequent the shingles of each counter are."""
    lowest = np.arange(len(level), dtype=np.uint64) << np.uint64(64 - COUNTER_BITS)
    key = _order_key(lowest, level)
    order = np.argsort(key)
    upto = np.cumsum(2.0 ** (level[order] / 1000) - 1)
    shares = upto[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS
    return key[order[np.minimum(np.searchsorted(upto, shares), len(order) - 1)]]


# --- Candidates ----------------------------------------------------------------------------------

_ENTRY = "shingle long, cls long, n int, pos int"


def _entries(width: int, percent: int, rarity):
    """The first shingles of each set in the global order, once per class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = rarity.value, set()
        for batch in batches:
            parts: list[tuple] = []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), width)
                n = len(found)
                if not n or (cls := _class_of(found)) in seen:
                    continue
                seen.add(cls)
                first = n - (percent * n + 99) // 100 + 1
                order = np.argsort(_order_key(found, level), kind="stable")[:first]
                parts.append((found[order].view(np.int64), cls, n, first))
            if parts:
                lengths = [p[3] for p in parts]
                yield _batch(
                    ["shingle", "cls", "n", "pos"],
                    pa.array(np.concatenate([p[0] for p in parts])),
                    pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), lengths)),
                    pa.array(np.repeat(np.array([p[2] for p in parts], np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
                )

    return run


def _possible(percent: int, n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Whether sets of n and m shingles whose first common one is at these positions can be linked."""
    shared = F.least(n - pos, m - at)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (
        100 * shared >= percent * (n + m - shared)
    )


def _roomy(percent: int, n: Column, pos: Column) -> Column:
    """Whether a set of n shingles can be linked, over one at this position, with a set that is not smaller.

    Of a link's two sets one has room for the other's size beyond its own or equal to it, so it is roomy.
    """
    return (100 + percent) * (n - pos) >= 2 * percent * n


def _with_first(entries: DataFrame) -> DataFrame:
    """Entries that are not the first class of their shingle, beside the first: (… , c, c_n, c_pos)."""
    order = Window.partitionBy("shingle").orderBy("pos", "cls")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beside = entries.select(
        "*",
        F.lag("cls").over(order).alias("previous"),
        *[F.first(a).over(upto).alias(b) for a, b in (("cls", "c"), ("n", "c_n"), ("pos", "c_pos"))],
    )
    return beside.filter((F.col("previous") != F.col("cls")) & (F.col("c") != F.col("cls"))).drop("previous")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


# --- Verification --------------------------------------------------------------------------------


def _fragments(width: int, marks, rarity, cuts: np.ndarray):
    """Fragments of the sets of marked documents, and of others whose id has the same hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(marks.value).astype(bool)
        level = rarity.value
        for batch in batches:
            wanted = marked[mark_of(batch.column("doc_id").to_numpy())]
            for k in np.flatnonzero(wanted):
                found = shingle_set(batch.column("text")[int(k)].as_py(), width)
                if not len(found):
                    continue
                cls = _class_of(found)
                key = _order_key(found, level)
                order = np.argsort(key, kind="stable")
                found, part = found[order], np.searchsorted(cuts, key[order], "right").astype(np.int32)
                kinds, starts = np.unique(part, return_index=True)
                offsets = np.append(starts, len(found)).astype(np.int32)
                yield _batch(
                    ["cls", "fragment", "part"],
                    pa.array(np.full(len(kinds), cls)),
                    pa.array(kinds),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.view(np.int64))),
                )

    return run


def _verified(
    spark: SparkSession, rows: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, percent: int,
    rarity, cuts: np.ndarray,
) -> DataFrame:
    """The pairs of classes that are links."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    sizes = stored(spark, classes.join(ends, "cls"), "sizes")
    marks = spark.sparkContext.broadcast(marks_of(sizes.select("first")))
    made = map_arrow(rows, _fragments(width, marks, rarity, cuts), "cls long, fragment int, part array<long>")
    parts = stored(spark, made, "fragments")
    return stored(spark, _links(pairs, parts, sizes, percent), "links")


def _links(pairs: DataFrame, parts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose overlap, summed over fragments, is enough."""
    few = pairs.count() <= BROADCAST_PAIRS
    sent = F.broadcast(pairs) if few else pairs
    left = parts.withColumnRenamed("cls", "a").join(sent, "a").withColumnRenamed("part", "part_a")
    right = parts.withColumnRenamed("cls", "b").join(sent, "b").withColumnRenamed("part", "part_b")
    shared = (
        left.join(right, ["a", "b", "fragment"])
        .select("a", "b", "fragment", F.size(F.array_intersect("part_a", "part_b")).alias("shared"))
        # A repeated row has its fragments twice.
        .groupBy("a", "b", "fragment")
        .agg(F.max("shared").alias("shared"))
        .groupBy("a", "b")
        .agg(F.sum("shared").alias("shared"))
    )
    n = sizes.select(F.col("cls").alias("a"), F.col("n_shingles").alias("n_a"))
    m = sizes.select(F.col("cls").alias("b"), F.col("n_shingles").alias("n_b"))
    return (
        shared.join(n, "a")
        .join(m, "b")
        .filter(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared")))
        .select("a", "b")
    )


def link_components(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`.

    A set holds a text's distinct shingles of `width` words, or the whole sequence of a shorter text;
    a null text or one without words has none and is linked with nothing. `component_id` is the least
    doc_id that links reach. Equal texts are linked, repeated rows each get their row. A row with
    a null doc_id links nothing and has a null component. An empty table gives an empty result. Other
    columns are not read. Sets are compared by 64-bit hashes of their shingles.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    profiles = stored(spark, map_arrow(rows, _profiles(width), _PROFILE), "profiles")
    known = profiles.filter("fragment IS NULL").select("doc_id", "n_shingles", "cls")
    classes = (
        known.filter("doc_id IS NOT NULL AND cls IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n_shingles"))
    )
    level = _rarity(spark, profiles)
    rarity, cuts = spark.sparkContext.broadcast(level), _cuts(level)

    named = rows.filter("doc_id IS NOT NULL")
    entries = map_arrow(named, _entries(width, percent, rarity), _ENTRY)
    beside = stored(spark, _with_first(entries), "beside-first")
    firsts = beside.select("shingle", F.col("c").alias("cls"), F.col("c_n").alias("n"), F.col("c_pos").alias("pos"))
    members = beside.select("shingle", "cls", "n", "pos", "c").union(
        firsts.distinct().select("*", F.col("cls").alias("c"))
    )

    n, pos, m, at = (F.col(c) for c in ("n", "pos", "c_n", "c_pos"))
    starred = stored(spark, _pairs(beside.filter(_possible(percent, n, pos, m, at)), "cls", "c"), "pairs")
    links = _verified(spark, named, starred, classes, width, percent, rarity, cuts)

    labels = components(spark, links)
    of = members.join(labels.withColumnRenamed("v", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls")
    )
    central = labels.select(F.col("v").alias("c"), F.col("label").alias("main"))
    of = stored(spark, of.join(central, "c", "left").withColumn("main", F.coalesce("main", "c")), "members")
    outside = of.filter("label <> main").select(
        "shingle", F.col("cls").alias("o"), F.col("n").alias("o_n"), F.col("pos").alias("o_pos"),
        F.col("label").alias("o_label"),
    )
    # Sets without room for their own size meet roomy ones only.
    outside = outside.withColumn("side", F.when(_roomy(percent, F.col("o_n"), F.col("o_pos")), 0).otherwise(1))
    sides = F.when(_roomy(percent, n, pos), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    across = of.withColumn("side", F.explode(sides)).join(outside, ["shingle", "side"]).filter(
        (F.col("label") != F.col("o_label"))
        & ((F.col("label") == F.col("main")) | (F.col("cls") < F.col("o")))
        & _possible(percent, n, pos, F.col("o_n"), F.col("o_pos"))
    )
    left = stored(spark, _pairs(across, "cls", "o").join(starred, ["a", "b"], "left_anti"), "pairs")
    more = _verified(spark, named, left, classes, width, percent, rarity, cuts)
    if more.limit(1).count():
        labels = components(spark, links.union(more))

    found = labels.select(F.col("v").alias("cls"), "label").join(classes.select("cls", "first"), "cls")
    lowest = found.groupBy("label").agg(F.min("first").alias("lowest"))
    linked = found.join(lowest, "label").select("cls", "lowest")
    ids = classes.join(linked, "cls", "left").select("cls", F.coalesce("lowest", "first").alias("component"))
    named_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return known.join(ids, "cls", "left").select("doc_id", "n_shingles", named_id.alias("component_id"))
