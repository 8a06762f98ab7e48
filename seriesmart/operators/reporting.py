"""Building blocks of the marts: select, pivot, lag, flag, rank and present."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmart.functions.keys import month_index
from seriesmart.functions.numbers import round_half_up


def _as_list(wanted) -> list:
    return list(wanted) if isinstance(wanted, (list, tuple)) else [wanted]


def select_facts(fact: DataFrame, series: DataFrame, where: dict) -> DataFrame:
    """Facts of the series whose attributes match, with those attributes.

    ``where`` maps an attribute to a value or a list of values. A fact that carries its dataflow is
    filtered by it, which prunes partitions of a stored fact while it is planned, and joined on it, which
    prunes them at run time by the dataflows of the selected series. Nothing is assumed of how a series
    id is spelled. The join strategy is left to adaptive execution: the selected series usually fit a
    broadcast, and where they do not, a series with very many facts is split.
    """
    shared = [c for c in ("source_dataflow",) if c in fact.columns]
    for attribute, wanted in where.items():
        series = series.filter(F.col(attribute).isin(_as_list(wanted)))
        if attribute in shared:
            fact = fact.filter(F.col(attribute).isin(_as_list(wanted)))
    return fact.join(series, ["series_id", *shared])


def slice_facts(fact: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Facts within a date range, open where None; the years of a partitioned fact are pruned with it."""
    years = "period_year" in fact.columns
    if first is not None:
        fact = fact.filter(F.col("date_key") >= F.lit(first))
        fact = fact.filter(F.col("period_year") >= first.year) if years else fact
    if last is not None:
        fact = fact.filter(F.col("date_key") <= F.lit(last))
        fact = fact.filter(F.col("period_year") <= last.year) if years else fact
    return fact


def pivot_measures(df: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Long to wide: one column per measure code."""
    wide = [
        F.max(F.when(F.col("measure_code") == code, F.col("obs_value"))).alias(name)
        for code, name in measures.items()
    ]
    return df.groupBy(*keys).agg(*wide)


def group_max(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def with_lags(df: DataFrame, partition: list[str], order: str, lags: dict[str, list[int]]) -> DataFrame:
    """Earlier values by position: ``<column>_lag<n>``.

    Meant for rows that are already one per entity and period, so that a partition is as long as
    the calendar. By position means that a missing period shifts the comparison.
    """
    window = W.partitionBy(*partition).orderBy(order)
    return df.withColumns(
        {f"{c}_lag{n}": F.lag(c, n).over(window) for c, steps in lags.items() for n in steps}
    )


def calendar_lag(
    df: DataFrame, partition: list[str], date: str, column: str, months: int
) -> DataFrame:
    """The value exactly ``months`` earlier, ``<column>_m<months>``; null where that is missing."""
    window = (
        W.partitionBy(*partition)
        .orderBy(month_index(F.col(date)))
        .rangeBetween(-months, -months)
    )
    return df.withColumn(f"{column}_m{months}", F.max(column).over(window))


def latest_date(df: DataFrame, date: str = "date") -> Column:
    """The last date of ``df`` as a scalar subquery.

    It is the date of the greatest row rather than the greatest date, so that the subquery needs
    every column of ``df`` and therefore plans the same exchanges as the query it is used in.
    Spark then reuses them and reads the input once.
    """
    others = [c for c in df.columns if c != date]
    last = F.max(F.struct(date, *others)).alias("last")
    return df.agg(last).select(F.col(f"last.{date}")).scalar()


def latest_flag(date: str, latest: Column) -> Column:
    return F.when(F.col(date) == latest, 1).otherwise(0)


def rank_within(partition: str, value: str) -> Column:
    """1 for the greatest value of each period; ties share a rank and leave a gap."""
    order = W.partitionBy(partition).orderBy(F.col(value).desc_nulls_last())
    return F.rank().over(order).cast("bigint")


def present(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round for presentation, as the last step: rounded values feed no other calculation."""
    return df.withColumns({c: round_half_up(F.col(c), n) for c, n in digits.items()})
