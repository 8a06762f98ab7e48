"""The figures document: every block of the gap analysis in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmart.operators import analysis as A

# The round years of the eras and the years the periods start from.
ERA_YEARS = [1978, 1990, 2000, 2010]
PERIODS_FROM = 2000
PACE_FROM = 2010


def gap_profile(ftpt: DataFrame, pace_from: int = PACE_FROM) -> DataFrame:
    return A.profile(A.with_gap(A.widen(ftpt)), pace_from)


def figures(
    ftpt: DataFrame,
    era_years: list[int] = ERA_YEARS,
    periods_from: int = PERIODS_FROM,
    pace_from: int = PACE_FROM,
) -> DataFrame:
    """One row, one struct column per block."""
    start, turn = F.lit(periods_from), F.year("trough_date")
    end = F.year(F.col("last")["date"])
    return gap_profile(ftpt, pace_from).select(
        F.struct(
            F.col("first")["date"].alias("from"), F.col("last")["date"].alias("to")
        ).alias("period"),
        A.headline().alias("headline"),
        A.turning_point().alias("turning_point"),
        A.eras(A.era_boundaries(era_years)).alias("eras"),
        A.contribution(start, turn).alias("before_turn"),
        A.contribution(turn, end).alias("after_turn"),
        A.contribution(start, end).alias(f"since_{periods_from}_naive"),
        A.levels().alias("levels"),
        A.male_parttime().alias("male_parttime"),
        A.pace(pace_from).alias("pace"),
    )


def figures_json(figures_row: DataFrame) -> DataFrame:
    """The document as one JSON string; an unknown figure is written as null."""
    text = F.to_json(F.struct(*figures_row.columns), {"ignoreNullFields": "false"})
    return figures_row.select(text.alias("figures"))
