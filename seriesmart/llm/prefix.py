"""Prefix sums within hot groups: two levels, so that no group is ever ordered in one task.

The order key is random, so equal ranges of it are equal shares of any group. Sums per group and range
are small; what comes before a range is added to a running sum inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a range holds on average.
RANGE_ROWS = 20_000


def ranges_for(rows: int, least: int = 64) -> int:
    """A power of two of ranges for so many rows."""
    return max(least, 1 << (rows // RANGE_ROWS).bit_length())


def prefix_sum(
    df: DataFrame, out: str, value: Column, group: list[Column], part: Column, order: list[Column]
) -> DataFrame:
    """`df` with `out`, the sum of `value` over the rows before in its group, 0 at first.

    `part` numbers ranges of the order; `order` sorts within one. `group` values are not null.
    """
    keys = [c.alias(f"__g{i}") for i, c in enumerate([*group, part])]
    names = [f"__g{i}" for i in range(len(keys))]
    keyed = df.select("*", *keys, value.alias("__v"))
    above = Window.partitionBy(*names[:-1]).orderBy(names[-1]).rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy(*names).agg(F.sum("__v").alias("__t"))
    before = totals.select(*names, F.coalesce(F.sum("__t").over(above), F.lit(0)).alias("__b"))
    inside = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.col("__b") + F.coalesce(F.sum("__v").over(inside), F.lit(0))
    return keyed.join(before, names).withColumn(out, running).drop(*names, "__v", "__b")


def group_key(column: Column) -> Column:
    """A value that is equal where `column` is equal or both are null, and never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))
