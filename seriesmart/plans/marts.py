"""The four marts over the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmart.functions.numbers import growth_category, pct_change, ppt_change, share_pct
from seriesmart.operators.reporting import (
    group_max,
    latest_date,
    latest_flag,
    pivot_measures,
    present,
    rank_within,
    require,
    select_facts,
    with_lags,
)
from seriesmart.schemas import LABOUR_ACCOUNT, LABOUR_FORCE, MART_CONTRACT

# Which series feed which mart.
NATIONAL = {
    "source_dataflow": LABOUR_FORCE,
    "region_code": "AUS",
    "sex_code": "3",
    "age_code": "1599",
    "tsest_code": "20",
    "measure_code": ["M3", "M6", "M12", "M13", "M16"],
}
STATES = {
    "source_dataflow": LABOUR_FORCE,
    "geography_level": ["State", "Territory"],
    "sex_code": "3",
    "age_code": "1599",
    "tsest_code": "30",
    "measure_code": ["M3", "M13"],
}
FULLTIME_PARTTIME = {
    "source_dataflow": LABOUR_FORCE,
    "region_code": "AUS",
    "age_code": "1599",
    "tsest_code": "20",
    "measure_code": ["M1", "M2", "M3"],
}
INDUSTRY = {
    "source_dataflow": LABOUR_ACCOUNT,
    "measure_code": "M9",
    "region_code": "AUS",
    "is_industry_division": 1,
}


def _facts(fact: DataFrame, series: DataFrame, where: dict) -> DataFrame:
    return select_facts(fact, series, where).withColumnRenamed("date_key", "date")


def _contract(df: DataFrame, name: str) -> DataFrame:
    return df.select(*MART_CONTRACT[name].fieldNames())


def _rate_change(steps: int) -> Column:
    rate = "unemployment_rate_pct"
    return ppt_change(F.col(rate), F.col(f"{rate}_lag{steps}"))


def _level_change(level: str, steps: int) -> Column:
    return pct_change(F.col(level), F.col(f"{level}_lag{steps}"))


def national_overview(fact: DataFrame, series: DataFrame) -> DataFrame:
    """One row per month: level, rates and their changes on a month and on a year."""
    measures = {
        "M3": "employed_thousands",
        "M6": "unemployed_thousands",
        "M12": "participation_rate_pct",
        "M13": "unemployment_rate_pct",
        "M16": "emp_to_pop_ratio_pct",
    }
    wide = pivot_measures(_facts(fact, series, NATIONAL), ["date"], measures)
    months = require(wide, ["employed_thousands", "unemployment_rate_pct"])
    # One row per month by now, so the unpartitioned window is as long as the calendar.
    lagged = with_lags(
        months, [], "date", {"unemployment_rate_pct": [1, 12], "employed_thousands": [1, 12]}
    )
    changes = lagged.withColumns(
        {
            "unemployment_rate_mom_change_ppt": _rate_change(1),
            "employed_mom_change_pct": _level_change("employed_thousands", 1),
            "unemployment_rate_yoy_change_ppt": _rate_change(12),
            "employed_yoy_change_pct": _level_change("employed_thousands", 12),
            "is_latest_month": latest_flag("date", latest_date(months)),
        }
    )
    digits = {name: 2 if name.endswith("_pct") else 1 for name in measures.values()}
    return _contract(present(changes, digits), "v_national_overview")


def unemployment_by_state(fact: DataFrame, series: DataFrame) -> DataFrame:
    """One row per month and state, on the one basis that every state publishes."""
    measures = {"M3": "employed_thousands", "M13": "unemployment_rate_pct"}
    keys = ["date", "region_code", "region_name"]
    wide = pivot_measures(_facts(fact, series, STATES), keys, measures)
    months = require(wide, ["unemployment_rate_pct"])
    lagged = with_lags(
        months,
        ["region_code"],
        "date",
        {"unemployment_rate_pct": [1, 12], "employed_thousands": [12]},
    )
    changes = lagged.withColumns(
        {
            "unemployment_rate_mom_change_ppt": _rate_change(1),
            "unemployment_rate_yoy_change_ppt": _rate_change(12),
            "employed_yoy_change_pct": _level_change("employed_thousands", 12),
            "is_latest_month": latest_flag("date", latest_date(months)),
        }
    )
    digits = {"employed_thousands": 1, "unemployment_rate_pct": 2}
    return _contract(present(changes, digits), "v_unemployment_by_state")


def fulltime_parttime(fact: DataFrame, series: DataFrame) -> DataFrame:
    """One row per month and sex. Persons is the total of the other two, not a third sex.

    Shares are rounded before their change is taken.
    """
    measures = {
        "M1": "employed_fulltime_thousands",
        "M2": "employed_parttime_thousands",
        "M3": "employed_total_thousands",
    }
    keys = ["date", "sex_code", "sex_name"]
    wide = pivot_measures(_facts(fact, series, FULLTIME_PARTTIME), keys, measures)
    months = require(wide, ["employed_total_thousands"])
    total = F.col("employed_total_thousands")
    shares = months.withColumns(
        {
            "fulltime_share_pct": share_pct(F.col("employed_fulltime_thousands"), total),
            "parttime_share_pct": share_pct(F.col("employed_parttime_thousands"), total),
        }
    )
    lagged = with_lags(
        shares,
        ["sex_code"],
        "date",
        {"fulltime_share_pct": [12], "employed_total_thousands": [12]},
    )
    changes = lagged.withColumns(
        {
            "fulltime_share_yoy_change_ppt": ppt_change(
                F.col("fulltime_share_pct"), F.col("fulltime_share_pct_lag12")
            ),
            "employed_total_yoy_change_pct": _level_change("employed_total_thousands", 12),
            "is_latest_month": latest_flag("date", latest_date(months)),
        }
    ).withColumnRenamed("sex_name", "sex_label")
    return _contract(
        present(changes, {name: 1 for name in measures.values()}), "v_fulltime_parttime"
    )


def industry_breakdown(fact: DataFrame, series: DataFrame) -> DataFrame:
    """One row per year and industry division, with rank, change and growth band."""
    keys = ["date", "industry_code", "industry_name", "is_focus_industry"]
    level, change = "employed_thousands", "employed_yoy_change_thousands"
    years = group_max(_facts(fact, series, INDUSTRY), keys, "obs_value", level)
    lagged = with_lags(years, ["industry_code"], "date", {level: [1]})
    changes = lagged.withColumns(
        {
            change: ppt_change(F.col(level), F.col(f"{level}_lag1")),
            "employed_yoy_change_pct": _level_change(level, 1),
            # Ranked before presentation rounding can make ties that are not in the data.
            "rank_by_employment": rank_within("date", level),
            "is_latest_year": latest_flag("date", latest_date(years)),
        }
    ).withColumn("growth_category", growth_category(F.col("employed_yoy_change_pct")))
    return _contract(present(changes, {level: 1, change: 1}), "v_industry_breakdown")


MART_VIEWS = {
    "national": "v_national_overview",
    "state": "v_unemployment_by_state",
    "ftpt": "v_fulltime_parttime",
    "industry": "v_industry_breakdown",
}


@dataclass(frozen=True)
class Marts:
    """The reporting layer."""

    national: DataFrame
    state: DataFrame
    ftpt: DataFrame
    industry: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {view: getattr(self, part) for part, view in MART_VIEWS.items()}

    @classmethod
    def of_names(cls, views: dict[str, DataFrame]) -> Marts:
        return cls(**{part: views[view] for part, view in MART_VIEWS.items()})


def build_marts(fact: DataFrame, series: DataFrame) -> Marts:
    return Marts(
        national=national_overview(fact, series),
        state=unemployment_by_state(fact, series),
        ftpt=fulltime_parttime(fact, series),
        industry=industry_breakdown(fact, series),
    )
