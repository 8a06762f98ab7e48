"""The four report pages and the workbook tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmart.functions.numbers import exact_avg, exact_sum
from seriesmart.operators.semantic import (
    Card,
    Chart,
    at_latest,
    auto_agg,
    crosstab,
    crosstab_with_totals,
    keep,
    page_rows,
    percent_of_total,
    slice_dates,
    to_millions,
    trailing_years,
    with_totals,
    with_year,
)

# The members of the sex dimension and the headers of the industry table.
SEXES = ["Persons", "Male", "Female"]
DETAIL_HEADERS = {
    "industry_name": "Industry",
    "employed_thousands": "Employed ('000)",
    "employed_yoy_change_pct": "YoY change",
    "growth_category": "Growth",
}


def page_overview(
    national: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Two monthly lines and six cards, under the page's date slicer."""
    charts = [
        Chart("Unemployment Rate Trend", "date", ("unemployment_rate_pct",)),
        Chart("Employed Persons", "date", ("employed_thousands",)),
    ]
    cards = [
        Card("Unemployment Rate", "unemployment_rate_pct"),
        Card("Employed ('000)", "employed_thousands"),
        Card("Participation Rate", "participation_rate_pct"),
        Card("Emp-to-Pop Ratio", "emp_to_pop_ratio_pct"),
        Card("Unemp. Rate MoM", "unemployment_rate_mom_change_ppt"),
        Card("Employed YoY %", "employed_yoy_change_pct"),
    ]
    return page_rows(slice_dates(national, first, last), charts, cards)


def page_state(state: DataFrame) -> DataFrame:
    """Two bars of the latest month and one line per state."""
    latest = F.col("is_latest_month") == 1
    charts = [
        Chart("Unemployment Rate by State", "region_name", ("unemployment_rate_pct",), where=latest, ranked=True),
        Chart("Employed Persons by State", "region_name", ("employed_thousands",), where=latest, ranked=True),
        Chart("Unemployment Rate Trend by State", "date", ("unemployment_rate_pct",), "region_name"),
    ]
    return page_rows(state, charts)


def page_industry(industry: DataFrame) -> DataFrame:
    """The bar of the latest year and the lines of the focus industries."""
    charts = [
        Chart(
            "Employed Persons by Industry",
            "industry_name",
            ("employed_thousands",),
            where=F.col("is_latest_year") == 1,
            ranked=True,
        ),
        Chart(
            "Employment Trend Focus Industries",
            "date",
            ("employed_thousands",),
            "industry_name",
            F.col("is_focus_industry") == 1,
        ),
    ]
    return page_rows(industry, charts)


def industry_detail(industry: DataFrame) -> DataFrame:
    """The page's table: latest year, display headers."""
    rows = keep(industry, "is_latest_year", [1]).select(*DETAIL_HEADERS)
    return rows.withColumnsRenamed(DETAIL_HEADERS)


def page_ftpt(ftpt: DataFrame) -> DataFrame:
    """Stacked levels of Persons, share by sex, the split by sex and three cards."""
    persons = F.col("sex_label") == "Persons"
    charts = [
        Chart(
            "Full-time vs Part-time Employed",
            "date",
            ("employed_fulltime_thousands", "employed_parttime_thousands"),
            where=persons,
        ),
        Chart("Full-time Share by Sex", "date", ("fulltime_share_pct",), "sex_label"),
        Chart(
            "Employment by Sex",
            "sex_label",
            ("employed_total_thousands",),
            where=(F.col("is_latest_month") == 1) & ~persons,
        ),
    ]
    cards = [
        Card("Full-time Share", "fulltime_share_pct", persons),
        Card("Part-time Share", "parttime_share_pct", persons),
        Card("FT Share YoY", "fulltime_share_yoy_change_ppt", persons),
    ]
    return page_rows(ftpt, charts, cards)


def employment_by_sex(ftpt: DataFrame) -> DataFrame:
    """The donut: each sex's share of employment in the latest month, the total left out."""
    split = keep(keep(ftpt, "sex_label", ["Persons"], exclude=True), "is_latest_month", [1])
    return percent_of_total(split, "sex_label", "employed_total_thousands")


def state_comparison(state: DataFrame) -> DataFrame:
    """Latest month only, highest rate first."""
    return (
        keep(state, "is_latest_month", [1])
        .orderBy(F.col("unemployment_rate_pct").desc(), "region_name")
        .select(
            "date",
            "region_name",
            "unemployment_rate_pct",
            "employed_thousands",
            "unemployment_rate_yoy_change_ppt",
            "employed_yoy_change_pct",
        )
    )


def share_crosstab(ftpt: DataFrame, members: list[str] = SEXES) -> DataFrame:
    """Average full-time share by year and sex."""
    return crosstab(with_year(ftpt), "year", "sex_label", members, "fulltime_share_pct")


def share_crosstab_totals(ftpt: DataFrame, members: list[str] = SEXES) -> DataFrame:
    """Average full-time share by year and sex, with the averages of years, sexes and all rows."""
    share = exact_avg(F.col("fulltime_share_pct"))
    return crosstab_with_totals(with_year(ftpt), "year", "sex_label", members, share)


#: What is shown of each mart under a slicer.
SLICED = {
    "national": ["unemployment_rate_pct", "employed_thousands", "unemployment_rate_yoy_change_ppt"],
    "state": ["unemployment_rate_pct", "employed_thousands", "employed_yoy_change_pct"],
    "ftpt": ["fulltime_share_pct", "employed_total_thousands", "fulltime_share_yoy_change_ppt"],
    "industry": ["employed_thousands", "employed_yoy_change_pct"],
}


def sliced_totals(marts: dict[str, DataFrame]) -> DataFrame:
    """(mart, measure, value) over the rows that are left of each mart, averaged or summed by name."""
    parts = [
        auto_agg(mart, [], SLICED[name]).unpivot([], SLICED[name], "measure", "value").withColumn("mart", F.lit(name))
        for name, mart in marts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def state_totals(state: DataFrame) -> DataFrame:
    """Measures of region and year with all totals, each evaluated in its own cell or total.

    Averages are over all rows, the level and the rate are those of the last date there is, the greatest of
    several regions, as the report's measures are; the rate by employment weighs each row.
    """
    weighted = F.col("unemployment_rate_pct") * F.col("employed_thousands")
    rows = with_year(state).withColumn("weighted", weighted)
    measures = {
        "average_rate": exact_avg(F.col("unemployment_rate_pct")),
        "latest_rate": at_latest("unemployment_rate_pct"),
        "latest_employed": at_latest("employed_thousands"),
        "n_rows": F.count("*"),
        "rate_by_employment": exact_sum(F.col("weighted")) / F.nullif(exact_sum(F.col("employed_thousands")), F.lit(0.0)),
    }
    return with_totals(rows, ["region_name", "year"], measures)


def ftpt_by_sex(ftpt: DataFrame, years: int = 15) -> DataFrame:
    """Full-time and part-time employment of each sex in millions, over the last years."""
    recent = keep(trailing_years(ftpt, years), "sex_label", ["Male", "Female"])
    levels = ["employed_fulltime_thousands", "employed_parttime_thousands"]
    return to_millions(recent, levels).select(
        "date", "sex_label", *[c.replace("_thousands", "_millions") for c in levels]
    )
