"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; rank r of n becomes the fraction
(2r + 1) / 2n. In order of the fraction all sources are spread evenly, so any contiguous cut has the
mixture of the whole, and cuts at equal counts give shards whose numbers of rows differ by one at
most. Both rankings are two-level prefix counts (`prefix.py`): by hash range within a source, and by
range of the fraction, of which every source fills an equal share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.llm.common import random_key, stored
from seriesmart.llm.mixing import KEY_BITS
from seriesmart.llm.prefix import group_key, prefix_sum, ranges_for

SHARDS = 40
SEED = 7


def interleave(
    spark: SparkSession,
    df: DataFrame,
    shards: int = SHARDS,
    source: str = "source",
    keys: tuple[str, ...] = ("doc_id",),
    seed: int = SEED,
) -> DataFrame:
    """`df` with `shard int` (0 to shards - 1) and `slot long` (0, 1, ... within the shard).

    Every row is placed, repeated rows too. A null source is a source. The order depends on `keys` and
    `seed`; rows that share all keys are interchangeable, so name enough columns to tell rows apart.
    With fewer rows than shards some shards stay empty; an empty table gives an empty result.
    Columns named `shard` or `slot` are replaced.
    """
    base = df.drop("shard", "slot")
    rows = base.select(
        "*",
        group_key(F.col(source)).alias("__group"),
        random_key(seed, *[F.col(k) for k in keys]).alias("__key"),
    )
    rows = stored(spark, rows, "shuffled")
    total = rows.count()
    ranges = ranges_for(total)
    tie = [F.col("__key"), *[F.col(k) for k in keys]]
    one = F.lit(1).cast("long")
    part = F.shiftright("__key", KEY_BITS - (ranges.bit_length() - 1))
    ranked = prefix_sum(rows, "__rank", one, [F.col("__group")], part, tie)
    sizes = rows.groupBy(F.col("__group").alias("__name")).agg(F.count("*").alias("__n"))
    sized = ranked.join(sizes, F.col("__group") == F.col("__name")).drop("__name")
    fraction = (2 * F.col("__rank") + 1).cast("double") / (2 * F.col("__n")).cast("double")
    spread = sized.withColumn("__at", fraction)
    place = prefix_sum(
        spread,
        "__place",
        one,
        [],
        F.floor(F.col("__at") * ranges),
        [F.col("__at"), F.col("__group"), *tie],
    )
    shard = F.expr(f"(__place * {shards}) div {max(total, 1)}")
    first = F.expr(f"((__place * {shards}) div {max(total, 1)} * {total} + {shards - 1}) div {shards}")
    return place.select(
        *base.columns, shard.cast("int").alias("shard"), (F.col("__place") - first).alias("slot")
    )
