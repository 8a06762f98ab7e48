"""Keys and dates of observations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations, independent of the session locale.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def series_key(prefix: str, dimensions: list[str]) -> Column:
    """Dataflow and every dimension code joined with dots; null if any code is null."""
    parts: list[Column] = [F.lit(prefix)]
    for name in dimensions:
        parts += [F.lit("."), F.col(name)]
    return F.concat(*parts)


def surrogate_key(series: Column, date: Column) -> Column:
    return F.concat(series, F.lit("|"), F.date_format(date, "yyyy-MM-dd"))


def parse_period(period: Column) -> Column:
    """``YYYY`` and ``YYYY-MM`` to the first day of the period; anything else fails the query.

    The dash is tested because a cast alone would read a year of five digits.
    """
    text = F.rtrim(period)
    rest = (
        F.when(F.length(text) == 4, "-01-01")
        .when(F.substring(text, 5, 1) == "-", "-01")
        .when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a period: "), text)).cast("string"))
    )
    return F.concat(text, rest).cast("date")


def month_index(date: Column) -> Column:
    """Months since year zero, so that a distance of 12 is one year whatever rows are missing."""
    return F.year(date) * 12 + F.month(date)


def financial_year_end(date: Column) -> Column:
    """The July to June year, named for the year it ends in."""
    return F.year(F.add_months(date, 6))


def month_label(date: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in MONTHS]), F.month(date))
