"""KPIs, filters and chart queries over a mart."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmart.functions.numbers import exact_avg, exact_sum, percent_of
from seriesmart.operators.reporting import latest_date

# --- Fixed values: which columns are averaged and how columns are typed, by name -----------------

AVERAGED = ("rate", "pct", "ratio", "share", "ppt")
NUMBER_SUFFIXES = ("_pct", "_ppt", "_thousands")
FLAG_PREFIXES = ("is_", "rank_")


def keep(df: DataFrame, column: str, values: list, exclude: bool = False) -> DataFrame:
    """Rows whose member is listed, or is not; a null member is not listed."""
    listed = F.coalesce(F.col(column).isin(values), F.lit(False))
    return df.filter(~listed if exclude else listed)


def slice_dates(df: DataFrame, first: dt.date | None, last: dt.date | None, date: str = "date") -> DataFrame:
    """Rows within a date range; an open end is None."""
    if first is not None:
        df = df.filter(F.col(date) >= F.lit(first))
    if last is not None:
        df = df.filter(F.col(date) <= F.lit(last))
    return df


def with_calendar(mart: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Calendar attributes for each row of a mart, many to one."""
    return mart.join(calendar.withColumnRenamed("date", date), date, "left")


def at_latest(column: str, where: Column | None = None, date: str = "date") -> Column:
    """Aggregate: the greatest value of a column on the last date.

    The last date is that of all rows; ``where`` limits only the rows the value is taken from.
    It is the greatest (date, value) pair, a null value being the least.
    """
    value = F.col(column) if where is None else F.when(where, F.col(column))
    return F.max(F.struct(F.col(date), value.alias("value")))["value"]


def at_flag(column: str, flag: str, where: Column | None = None) -> Column:
    """Aggregate: the greatest value of a column over the rows a latest-flag marks."""
    marked = F.col(flag) == 1
    return F.max(F.when(marked if where is None else marked & where, F.col(column)))


def latest_value(
    df: DataFrame, columns: list[str], where: Column | None = None, date: str = "date"
) -> DataFrame:
    """One row: the value of each column on the last date of ``df``."""
    return df.agg(*[at_latest(c, where, date).alias(c) for c in columns])


def flagged_value(
    df: DataFrame, flag: str, columns: list[str], where: Column | None = None, by: str | None = None
) -> DataFrame:
    """The value of each column under the latest-flag, overall or by entity."""
    rows = df.filter(F.col(flag) == 1)
    return rows.groupBy(*([by] if by else [])).agg(
        *[at_flag(c, flag, where).alias(c) for c in columns]
    )


def is_averaged(column: str) -> bool:
    return any(part in column for part in AVERAGED)


def auto_agg(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Group, averaging rates and shares and summing everything else, as the names tell."""
    totals = [(exact_avg if is_averaged(c) else exact_sum)(F.col(c)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*totals)


def chart_query(
    df: DataFrame,
    category: str,
    values: list[str],
    series: str | None = None,
    filters: list[tuple[str, list, bool]] | None = None,
    sort: str | None = None,
) -> DataFrame:
    """The rows behind one chart; ``sort`` is asc or desc by the first value."""
    for column, members, exclude in filters or []:
        df = keep(df, column, members, exclude)
    result = auto_agg(df, [category, *([series] if series else [])], values)
    if sort is None:
        return result
    value = F.col(values[0])
    return result.orderBy(value.desc() if sort == "desc" else value.asc(), category)


def percent_of_total(df: DataFrame, category: str, value: str) -> DataFrame:
    """Sum per category and its percentage of the sum of all."""
    slices = df.groupBy(category).agg(exact_sum(F.col(value)).alias(value))
    total = slices.agg(exact_sum(F.col(value)).alias("total")).scalar()
    return slices.withColumn("percent_of_total", percent_of(F.col(value), total))


def trailing_years(df: DataFrame, years: int, date: str = "date") -> DataFrame:
    """Rows no older than ``years`` before the last date, that day included."""
    return df.filter(F.col(date) >= F.add_months(latest_date(df, date), -12 * years))


def latest_row(df: DataFrame, date: str = "date", entity: str | None = None) -> DataFrame:
    """The row of the last date; of several entities the first by name or code."""
    ties = [F.col(entity)] if entity else []
    return df.orderBy(F.col(date).desc(), *ties).limit(1)


def to_millions(df: DataFrame, columns: list[str]) -> DataFrame:
    """Thousands to millions."""
    return df.withColumns({c.replace("_thousands", "_millions"): F.col(c) / 1000 for c in columns})


def type_of_name(column: str) -> T.DataType:
    if column == "date":
        return T.DateType()
    if column.startswith(FLAG_PREFIXES):
        return T.LongType()
    if column.endswith(NUMBER_SUFFIXES):
        return T.DoubleType()
    return T.StringType()


def type_by_name(df: DataFrame) -> DataFrame:
    """Text columns of a re-read export to the types their names stand for."""
    return df.select(*[F.col(c).cast(type_of_name(c)).alias(c) for c in df.columns])


def with_year(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumn("year", F.year(date))


def crosstab(df: DataFrame, row: str, column: str, members: list[str], value: str) -> DataFrame:
    """Average of ``value`` with one column per member, rows in descending order."""
    cells = [
        exact_avg(F.when(F.col(column) == m, F.col(value))).alias(m) for m in members
    ]
    return keep(df, column, members).groupBy(row).agg(*cells).orderBy(F.col(row).desc())


def with_totals(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Each measure for every cell and every total: (keys, level, measures).

    A total is the measure evaluated anew over all rows below it, not a sum of cells, so averages, ratios
    and values on the last date have theirs. ``level`` tells totals from null members: its bits, the first
    key's highest, are 1 for the keys a row totals over. One scan and one shuffle for all levels.
    """
    return df.cube(*keys).agg(
        F.grouping_id().cast("int").alias("level"), *[m.alias(name) for name, m in measures.items()]
    )


def crosstab_with_totals(
    df: DataFrame, row: str, column: str, members: list[str], measure: Column
) -> DataFrame:
    """A cross-tab with one column per member, a column ``total`` and a row of totals.

    ``is_total`` marks that row; its member is null. Rows are in descending order, the totals last.
    """
    cells = with_totals(keep(df, column, members), [row, column], {"value": measure})
    level = F.col("level")
    of_rows = level.bitwiseAND(F.lit(1)) == 1
    columns = [F.max(F.when(~of_rows & (F.col(column) == m), F.col("value"))).alias(m) for m in members]
    wide = cells.groupBy(row, (level >= 2).cast("int").alias("is_total")).agg(
        *columns, F.max(F.when(of_rows, F.col("value"))).alias("total")
    )
    return wide.orderBy("is_total", F.col(row).desc())


def slice_calendar(
    marts: dict[str, DataFrame], calendar: DataFrame, where: dict[str, list], date: str = "date"
) -> dict[str, DataFrame]:
    """All marts on the dates of a calendar whose attributes match: one slicer moves every visual.

    The dates are joined to the finished rows of a mart. Its lags, ranks and flags were taken over the
    whole history, as in the mart itself; a filter below them would change the first rows of the slice.
    Only the dates that are left reach the join, few enough for a broadcast by their size.
    """
    for attribute, members in where.items():
        calendar = keep(calendar, attribute, members)
    dates = calendar.select(F.col("date").alias(date))
    return {name: mart.join(dates, date, "left_semi") for name, mart in marts.items()}


# --- Report pages --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Chart:
    """A chart of a page: values by category, split by series, over the rows of a filter.

    The categories of a ranked chart are numbered from the greatest value down.
    """

    name: str
    category: str
    values: tuple[str, ...]
    series: str | None = None
    where: Column | None = None
    ranked: bool = False


@dataclass(frozen=True)
class Card:
    """A single figure of a page: the value on the last date of the page, by member or overall."""

    name: str
    value: str
    where: Column | None = None


def page_rows(mart: DataFrame, charts: list[Chart], cards: list[Card] = ()) -> DataFrame:
    """All visuals of a page in one pass: (visual, category, series, measure, value, position).

    Each mart row is emitted once per visual it belongs to, so a page costs one run of the mart
    and one aggregation whatever the number of its visuals.
    """

    def entry(visual: str, kind: str, category: Column, series: Column, measure: str, value: Column):
        return F.struct(
            F.lit(visual).alias("visual"),
            F.lit(kind).alias("kind"),
            category.cast("string").alias("category"),
            series.cast("string").alias("series"),
            F.lit(measure).alias("measure"),
            F.col("date").alias("date"),
            value.cast("double").alias("value"),
        )

    null = F.lit(None)
    entries = []
    for chart in charts:
        series = F.col(chart.series) if chart.series else null
        for measure in chart.values:
            kind = "average" if is_averaged(measure) else "sum"
            row = entry(chart.name, kind, F.col(chart.category), series, measure, F.col(measure))
            entries.append(row if chart.where is None else F.when(chart.where, row))
    for card in cards:
        # A row outside the filter still counts for the last date, hence a null value, not no row.
        value = F.col(card.value) if card.where is None else F.when(card.where, F.col(card.value))
        entries.append(entry(card.name, "latest", null, null, card.value, value))
    rows = mart.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    keys = ["visual", "kind", "category", "series", "measure"]
    totals = rows.groupBy(*keys).agg(
        exact_sum(F.col("value")).alias("sum"),
        exact_avg(F.col("value")).alias("average"),
        F.max(F.struct("date", "value"))["value"].alias("latest"),
    )
    kind = F.col("kind")
    value = (
        F.when(kind == "sum", F.col("sum"))
        .when(kind == "average", F.col("average"))
        .otherwise(F.col("latest"))
    )
    rows = totals.select("visual", "category", "series", "measure", value.alias("value"))
    ranked = F.col("visual").isin([c.name for c in charts if c.ranked])
    # Only the categories of a ranked chart meet in one partition, every other row has its own.
    together = F.when(~ranked, F.struct("category", "series", "measure"))
    order = W.partitionBy("visual", together).orderBy(F.col("value").desc_nulls_last(), "category")
    return rows.withColumn("position", F.when(ranked, F.row_number().over(order).cast("bigint")))
