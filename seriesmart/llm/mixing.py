"""Mixing sources to target weights: hash-random order within each source, cut at its budget.

Budgets. Sources in code point order, null last, have the weights in turn and share all sizes by weight.
No source is asked for more than `most` times its size; what is over is shared again by weight. The
common level is the largest of (all - capped) / (weight left) over the sources in order of the size
at which they are capped, so it needs no loop.

Cut. A source with a budget of e whole epochs and a rest takes every document e times, and once more
those that come first in a random order until the rest is reached: a document is in if its middle is
within the rest, so a source misses its budget by half a document at most. Prefix sums have two
levels (`prefix.py`), so a source that holds most rows is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmart.llm.common import random_key, stored
from seriesmart.llm.prefix import group_key, prefix_sum, ranges_for

#: Columns that a mix adds.
NAMES = ("source_size", "target", "repeats", "taken")
# Fixed values of the mix.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20
KEY_BITS = 60


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """(source, source_size) with `target double`. One row per source, so global windows are small."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("w", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    # The null source orders by its weight and cap as any other; ties give the same level.
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    free = F.sum("source_size").over(everything).cast("double") - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    level = ranked.withColumn("level", free / left)
    target = F.least(F.col("cap"), F.max("level").over(everything) * F.col("w"))
    return level.select("source", "source_size", target.alias("target"))


def mix(
    spark: SparkSession,
    df: DataFrame,
    size: str = "size",
    source: str = "source",
    keys: tuple[str, ...] = ("doc_id",),
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    names: tuple[str, str, str, str] = NAMES,
) -> DataFrame:
    """`df` with `source_size long`, `target double`, `repeats long` and `taken long` (repeats * size).

    Every row is kept, with `repeats` 0 if the mix leaves it out. Null sizes count as 0; rows of size 0
    are repeated like their neighbours in the order and take nothing. A null source is a source,
    the last. The order depends on `keys` and `seed` alone; rows that share a key are ordered by
    size, and equal rows are interchangeable. An empty table gives an empty result. `names` are those
    of the four columns; columns of `df` that have them are replaced.
    """
    base = df.drop(*names)
    rows = base.select(
        "*",
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("__size"),
        F.col(source).alias("__source"),
        random_key(seed, *[F.col(k) for k in keys]).alias("__key"),
    )
    rows = stored(spark, rows, "mix")
    sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "__name")
    targets = targets.select(
        group_key(F.col("__name")).alias("__group"),
        F.col("source_size").alias("__all"),
        F.col("target").alias("__target"),
    )
    ranges = ranges_for(rows.count())
    part = F.shiftright("__key", KEY_BITS - (ranges.bit_length() - 1))
    ordered = prefix_sum(
        rows.withColumn("__group", group_key(F.col("__source"))),
        "__before",
        F.col("__size"),
        [F.col("__group")],
        part,
        [F.col("__key"), *[F.col(k) for k in keys], F.col("__size")],
    )
    full = F.when(F.col("__all") > 0, F.floor(F.col("__target") / F.col("__all"))).otherwise(F.lit(0))
    rest = F.col("__target") - full * F.col("__all")
    more = (full < most) & (2 * F.col("__before") + F.col("__size") <= 2 * rest)
    repeats = (full + F.when(more, 1).otherwise(0)).cast("long")
    return (
        ordered.join(targets, "__group")
        .withColumn("__repeats", repeats)
        .select(
            *base.columns,
            F.col("__all").alias(names[0]),
            F.col("__target").alias(names[1]),
            F.col("__repeats").alias(names[2]),
            (F.col("__repeats") * F.col("__size")).alias(names[3]),
        )
    )


def apply_mix(mixed: DataFrame, names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """The documents of a mix, each as often as it is repeated, without the mix's own columns."""
    times = F.col(names[2])
    copies = mixed.filter(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    return copies.drop("__copy", *names)
