"""Star schema: a month dimension, a series dimension and one narrow fact.

The dimensions depend only on which series and periods occur, not on which of several copies is
kept, so they may be built from typed observations and need not wait for the deduplication.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.functions.keys import financial_year_end, month_label, surrogate_key
from seriesmart.operators.staging import CODES
from seriesmart.sources.codelists import CodeLists

SERIES_ATTRIBUTES = ["series_id", "source_dataflow", *CODES]


def period_bounds(observations: DataFrame, date: str = "period_date") -> DataFrame:
    """One row with the first and the last period."""
    return observations.agg(F.min(date).alias("first_period"), F.max(date).alias("last_period"))


def month_spine(bounds: DataFrame) -> DataFrame:
    """Every month between the bounds, with or without observations."""
    months = F.sequence("first_period", "last_period", F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("date_key"))


def calendar_columns(df: DataFrame, date: str) -> DataFrame:
    """Year, month, quarter and financial year of a date column."""
    day = F.col(date)
    year = F.year(day)
    return df.withColumns(
        {
            "year": year,
            "month_number": F.month(day),
            "month_name": month_label(day),
            "month_year": F.concat(month_label(day), F.lit(" "), year.cast("string")),
            "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
            "quarter_number": F.quarter(day),
            "financial_year": F.concat(F.lit("FY"), financial_year_end(day).cast("string")),
        }
    )


def dim_date(observations: DataFrame, date: str = "period_date") -> DataFrame:
    return calendar_columns(month_spine(period_bounds(observations, date)), "date_key")


def day_spine(
    spark: SparkSession, end: dt.date | DataFrame, start: dt.date = dt.date(1978, 1, 1)
) -> DataFrame:
    """The reporting calendar: one row per day from ``start`` to ``end``, both included.

    ``end`` is a date, or rows whose last ``date`` it is; those are read when the calendar is. Without a
    date from ``start`` on the calendar has one day.
    """
    last = end.agg(F.max("date").alias("last")) if isinstance(end, DataFrame) else spark.range(1).select(F.lit(end).alias("last"))
    days = F.sequence(F.lit(start), F.greatest("last", F.lit(start)), F.expr("interval 1 day"))
    calendar = calendar_columns(last.select(F.explode(days).alias("date")), "date")
    return calendar.drop("quarter_number").withColumns(
        {
            "financial_year_sort": financial_year_end(F.col("date")),
            "is_first_of_month": (F.day("date") == 1).cast("int"),
        }
    )


def distinct_series(observations: DataFrame) -> DataFrame:
    return observations.select(*SERIES_ATTRIBUTES).distinct()


def decode(
    df: DataFrame, codes: DataFrame, key: str, fallbacks: dict[str, Column | None]
) -> DataFrame:
    """Left join of a code list; a label that is not found falls back, or stays null on None."""
    labels = codes.select(key, *fallbacks)
    joined = df.join(labels, key, "left")
    filled = {
        label: F.coalesce(F.col(label), other)
        for label, other in fallbacks.items()
        if other is not None
    }
    return joined.withColumns(filled) if filled else joined


def dim_series(observations: DataFrame, codes: CodeLists) -> DataFrame:
    """One row per series with every code decoded.

    A measure that is not in the code list keeps null labels, so that a not-null check stops it.
    """
    unknown, none, zero = F.lit("Unknown"), F.lit("Not applicable"), F.lit(0)
    series = distinct_series(observations)
    series = decode(
        series,
        codes.measure,
        "measure_code",
        {"measure_name": None, "measure_unit": None, "employment_type": None},
    )
    series = decode(series, codes.sex, "sex_code", {"sex_name": none})
    series = decode(
        series,
        codes.adjustment,
        "tsest_code",
        {"adjustment_type": none, "is_seasonally_adjusted": zero},
    )
    series = decode(
        series,
        codes.region,
        "region_code",
        {"region_name": F.col("region_code"), "geography_level": unknown},
    )
    series = decode(
        series,
        codes.industry.withColumnRenamed("is_division", "is_industry_division"),
        "industry_code",
        {
            "industry_name": F.col("industry_code"),
            "is_industry_division": zero,
            "is_focus_industry": zero,
        },
    )
    frequency = F.col("frequency_code")
    return series.withColumn(
        "frequency",
        F.when(frequency == "M", "Monthly").when(frequency == "A", "Annual").otherwise("Unknown"),
    ).select(
        "series_id",
        "source_dataflow",
        "measure_code", "measure_name", "measure_unit", "employment_type",
        "sex_code", "sex_name",
        "tsest_code", "adjustment_type", "is_seasonally_adjusted",
        "region_code", "region_name", "geography_level",
        "industry_code", "industry_name", "is_industry_division", "is_focus_industry",
        "frequency_code", "frequency",
        "age_code",
    )


#: What the stored fact is partitioned by.
FACT_PARTITIONS = ["source_dataflow", "period_year"]


def fct_observations(staged: DataFrame, partitioned: bool = False) -> DataFrame:
    """Series, date and value; what the value means is an attribute of the series.

    ``partitioned`` adds the columns that the stored fact is partitioned by, which selections of
    dataflows and dates are narrowed with.
    """
    extra = [F.col("source_dataflow"), F.year("period_date").alias("period_year")]
    return staged.select(
        surrogate_key(F.col("series_id"), F.col("period_date")).alias("series_period_key"),
        "series_id",
        F.col("period_date").alias("date_key"),
        "obs_value",
        "source_extract",
        *(extra if partitioned else []),
    )
