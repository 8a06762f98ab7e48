"""Staging: raw observations to one typed, keyed and deduplicated long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmart.functions.keys import parse_period, series_key
from seriesmart.schemas import ACCOUNT_DIMENSIONS, LABOUR_ACCOUNT, LABOUR_FORCE, LF_DIMENSIONS

CODES = [
    "measure_code", "sex_code", "age_code", "tsest_code", "region_code", "industry_code",
    "frequency_code",
]

STAGED = [
    "series_id", "period_date", "source_dataflow", "source_extract", *CODES, "source_period",
    "obs_value", "unit_measure", "unit_mult",
]

# Which raw column holds which code; a code without a column does not apply to the dataflow.
LF_CODES = {
    "measure_code": "measure",
    "sex_code": "sex",
    "age_code": "age",
    "tsest_code": "tsest",
    "region_code": "region",
    "frequency_code": "freq",
}
ACCOUNT_CODES = {
    "measure_code": "measure",
    "region_code": "asgs_2016",
    "industry_code": "labouracct_ind",
    "frequency_code": "freq",
}


def _aligned(raw: DataFrame, dataflow: str, dimensions: list[str], codes: dict[str, str]) -> DataFrame:
    def code(name: str) -> Column:
        return (F.col(codes[name]) if name in codes else F.lit(None).cast("string")).alias(name)

    return raw.select(
        series_key(dataflow, dimensions).alias("series_id"),
        F.lit(dataflow).alias("source_dataflow"),
        "source_extract",
        *[code(name) for name in CODES],
        "time_period",
        "obs_value",
        "unit_measure",
        "unit_mult",
    )


def align_and_union(raw_lf: DataFrame | None, raw_account: DataFrame | None) -> DataFrame:
    """Both dataflows on one set of columns; a code that does not apply is null."""
    parts = []
    if raw_lf is not None:
        parts.append(_aligned(raw_lf, LABOUR_FORCE, LF_DIMENSIONS, LF_CODES))
    if raw_account is not None:
        parts.append(_aligned(raw_account, LABOUR_ACCOUNT, ACCOUNT_DIMENSIONS, ACCOUNT_CODES))
    if not parts:
        raise ValueError("no dataflow given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drop_gaps(df: DataFrame, value: str = "obs_value") -> DataFrame:
    return df.filter(F.col(value).isNotNull())


def typed_observations(
    raw_lf: DataFrame | None = None, raw_account: DataFrame | None = None
) -> DataFrame:
    """Aligned, without gaps, dated and typed; overlapping copies are still there."""
    observed = drop_gaps(align_and_union(raw_lf, raw_account))
    return observed.select(
        "series_id",
        parse_period(F.col("time_period")).alias("period_date"),
        "source_dataflow",
        "source_extract",
        *CODES,
        F.col("time_period").alias("source_period"),
        F.col("obs_value").cast("double").alias("obs_value"),
        "unit_measure",
        "unit_mult",
    )


def dedupe(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the first by ``order_by``, the remaining columns breaking ties.

    Because only the first row is kept, Spark limits each key to one row per task before the
    shuffle, so a key that holds most of the table stays small.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    window = W.partitionBy(*keys).orderBy(*order_by, *rest)
    numbered = df.withColumn("copy_number", F.row_number().over(window))
    return numbered.filter(F.col("copy_number") == 1).drop("copy_number")


def deduplicated(typed: DataFrame) -> DataFrame:
    """One row per series and period; of overlapping extracts the alphabetically first is kept.

    A series id begins with its dataflow, so that is part of the key, and a filter on it passes below.
    """
    return dedupe(typed, ["source_dataflow", "series_id", "period_date"], ["source_extract"]).select(*STAGED)


def stg_observations(
    raw_lf: DataFrame | None = None, raw_account: DataFrame | None = None
) -> DataFrame:
    """The staging layer: aligned, dated, typed, without gaps and without copies."""
    return deduplicated(typed_observations(raw_lf, raw_account))
