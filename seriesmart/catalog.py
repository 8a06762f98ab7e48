"""Every query of the engine over a folder of order tables, by name.

Each takes (spark, folder) and reads the tables it needs and no others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.functions.keys import series_key
from seriesmart.functions.labels import delta_status
from seriesmart.functions.numbers import round_half_up
from seriesmart.operators import analysis as A
from seriesmart.operators import quality as Q
from seriesmart.operators import semantic as S
from seriesmart.operators.reporting import calendar_lag, with_lags
from seriesmart.operators.staging import (
    dedupe,
    deduplicated,
    stg_observations,
    typed_observations,
)
from seriesmart.operators.star import day_spine, dim_date, dim_series, fct_observations
from seriesmart.plans import gap_report, kpis, marts, pages
from seriesmart.plans.checks import CHECKS
from seriesmart.plans.views import marts_by_sql
from seriesmart.schemas import (
    ACCOUNT_DIMENSIONS,
    EXTRACTS,
    LABOUR_ACCOUNT,
    LABOUR_FORCE,
    LF_DIMENSIONS,
    RAW_LF,
)
from seriesmart.sources import observations as O
from seriesmart.sources import orders as B
from seriesmart.sources.codelists import load_seed

Query = Callable[[SparkSession, str], DataFrame]

# Overlapping extracts: both carry total employment of all persons.
OVERLAPPING = ("national_summary", "national_fulltime_parttime")
ERA_YEARS = [1995, 1996, 1997]
SLICE_FROM = 1998
SLICED_YEARS = ["FY1996", "FY1997"]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- Shared inputs -------------------------------------------------------------------------------


def _star(
    spark: SparkSession, d: str, extracts: tuple = (), account: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Fact and series dimension of the dataflows and extracts a query selects from."""
    lf = B.lf_observations(spark, d, extracts) if extracts else None
    acct = B.account_observations(spark, d) if account else None
    typed = typed_observations(lf, acct)
    return fct_observations(deduplicated(typed), partitioned=True), dim_series(typed, B.code_lists(spark, d))


def _national(spark: SparkSession, d: str) -> DataFrame:
    return marts.national_overview(*_star(spark, d, OVERLAPPING))


def _state(spark: SparkSession, d: str) -> DataFrame:
    return marts.unemployment_by_state(*_star(spark, d, (B.STATE_EXTRACT,)))


def _ftpt(spark: SparkSession, d: str) -> DataFrame:
    return marts.fulltime_parttime(*_star(spark, d, OVERLAPPING))


def _industry(spark: SparkSession, d: str) -> DataFrame:
    return marts.industry_breakdown(*_star(spark, d, account=True))


def _all_marts(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All marts of one star, so that they share its dimension and its deduplication."""
    built = marts_by_sql(*_star(spark, d, (*OVERLAPPING, B.STATE_EXTRACT), account=True))
    return {part: getattr(built, part) for part in marts.MART_VIEWS}


def _national_marts(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    fact, series = _star(spark, d, OVERLAPPING)
    return {
        "national": marts.national_overview(fact, series),
        "ftpt": marts.fulltime_parttime(fact, series),
    }


def _days(spark: SparkSession, d: str) -> DataFrame:
    """The reporting calendar up to the last order."""
    return day_spine(spark, B.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")))


# --- Ingestion -----------------------------------------------------------------------------------


@query
def ingest_append_coerce(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the text of three extracts, cleaned, aligned, tagged and appended."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    amount = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    text = B.table(spark, d, "orders").select(
        F.lit("LF").alias("DATAFLOW"),
        F.lit("M3").alias("MEASURE"),
        F.when(priority.isin(B.MALE_PRIORITIES), "1").otherwise("2").alias("SEX"),
        F.lit("1599").alias("AGE"),
        F.lit("10").alias("TSEST"),
        F.col("o_custkey").cast("string").alias("REGION"),
        F.lit("M").alias("FREQ"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM").alias("TIME_PERIOD"),
        F.when(priority == "5-LOW", "n/a")
        .when(priority == "4-NOT SPECIFIED", "")
        .when((priority == "3-MEDIUM") & (status == "P"), "abc")
        .otherwise(amount)
        .alias("OBS_VALUE"),
        F.lit("NUM").alias("UNIT_MEASURE"),
        F.when(status == "P", "NaN").when(status == "O", "3.0").otherwise("0").alias("UNIT_MULT"),
        status.alias("OBS_STATUS"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("OBS_COMMENT"),
    )
    # One pass: the extract of a row follows from its status, and any other status has one too.
    columns = [c for c in RAW_LF.fieldNames() if c != "source_extract"]
    clean = O.null_tokens(O.project_columns(text, columns))
    typed = O.coerce_numeric(clean, doubles=["obs_value"], integers=["unit_mult"])
    first = F.when(F.col("obs_status") == "F", "national_summary")
    lineage = first.when(F.col("obs_status") == "O", "national_trend").otherwise("state_summary")
    return typed.withColumn("source_extract", lineage).select(*RAW_LF.fieldNames())


@query
def select_series_key(spark: SparkSession, d: str) -> DataFrame:
    return O.select_series(B.lf_observations(spark, d), LF_DIMENSIONS, B.STATE_KEY)


@query
def select_any_member(spark: SparkSession, d: str) -> DataFrame:
    return O.select_series(B.account_observations(spark, d), ACCOUNT_DIMENSIONS, "M9.AUS..A")


@query
def member_counts(spark: SparkSession, d: str) -> DataFrame:
    states = B.lf_observations(spark, d, [B.STATE_EXTRACT])
    return O.check_member_counts(states, {"region": 8, "measure": 2, "sex": 1})


@query
def members_found(spark: SparkSession, d: str) -> DataFrame:
    return O.members_found(B.account_observations(spark, d), ["labouracct_ind", "time_period"])


@query
def ingest_report(spark: SparkSession, d: str) -> DataFrame:
    monthly = [e for e in EXTRACTS if e.dataflow == LABOUR_FORCE]
    landed = B.lf_observations(spark, d, ("national_summary", "national_trend", B.STATE_EXTRACT))
    states = load_seed(spark, "seed_region").filter("geography_level <> 'National'")
    return O.ingest_report(landed, monthly, {"region": states})


@query
def slice_from_year(spark: SparkSession, d: str) -> DataFrame:
    """Monthly and annual rows: of the monthly ones those from a year on, of the annual ones all."""
    columns = ["source_extract", "dataflow", "measure", "freq", "time_period", "obs_value"]
    both = B.lf_observations(spark, d).select(*columns).unionByName(B.account_observations(spark, d).select(*columns))
    return O.slice_from_year(both, SLICE_FROM)


# --- Staging -------------------------------------------------------------------------------------


@query
def stg_series_key(spark: SparkSession, d: str) -> DataFrame:
    def keyed(raw: DataFrame, dataflow: str, dimensions: list[str]) -> DataFrame:
        return raw.select(
            series_key(dataflow, dimensions).alias("series_id"), "source_extract", "time_period"
        )

    monthly = keyed(B.lf_observations(spark, d), LABOUR_FORCE, LF_DIMENSIONS)
    annual = keyed(B.account_observations(spark, d), LABOUR_ACCOUNT, ACCOUNT_DIMENSIONS)
    return monthly.unionByName(annual)


@query
def stg_union_period(spark: SparkSession, d: str) -> DataFrame:
    return typed_observations(B.lf_observations(spark, d), B.account_observations(spark, d))


@query
def stg_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Line items hold several rows for one order line; the earliest shipped is kept."""
    return dedupe(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def stg_labour_force(spark: SparkSession, d: str) -> DataFrame:
    return stg_observations(B.lf_observations(spark, d), B.account_observations(spark, d))


# --- Star ----------------------------------------------------------------------------------------


@query
def dim_date_months(spark: SparkSession, d: str) -> DataFrame:
    return dim_date(
        typed_observations(B.lf_observations(spark, d), B.account_observations(spark, d))
    )


@query
def dim_series_decoded(spark: SparkSession, d: str) -> DataFrame:
    observed = typed_observations(B.lf_observations(spark, d), B.account_observations(spark, d))
    return dim_series(observed, B.code_lists(spark, d))


@query
def fct_labour_force(spark: SparkSession, d: str) -> DataFrame:
    return fct_observations(
        stg_observations(B.lf_observations(spark, d), B.account_observations(spark, d))
    )


# --- Marts ---------------------------------------------------------------------------------------


@query
def mart_national(spark: SparkSession, d: str) -> DataFrame:
    return _national(spark, d)


@query
def mart_region(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d)


@query
def mart_ftpt(spark: SparkSession, d: str) -> DataFrame:
    return _ftpt(spark, d)


@query
def mart_industry(spark: SparkSession, d: str) -> DataFrame:
    return _industry(spark, d)


@query
def mart_national_full_star(spark: SparkSession, d: str) -> DataFrame:
    """The national mart selected from a star of every extract of both dataflows."""
    return marts.national_overview(*_star(spark, d, B.LF_EXTRACTS, account=True))


@query
def mart_region_full_star(spark: SparkSession, d: str) -> DataFrame:
    return marts.unemployment_by_state(*_star(spark, d, B.LF_EXTRACTS, account=True))


@query
def mart_ftpt_full_star(spark: SparkSession, d: str) -> DataFrame:
    return marts.fulltime_parttime(*_star(spark, d, B.LF_EXTRACTS, account=True))


@query
def mart_industry_full_star(spark: SparkSession, d: str) -> DataFrame:
    return marts.industry_breakdown(*_star(spark, d, B.LF_EXTRACTS, account=True))


@query
def calendar_and_positional_lag(spark: SparkSession, d: str) -> DataFrame:
    """Orders per customer and month against the twelfth row before and the month a year before."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("date")
    monthly = (
        B.table(spark, d, "orders")
        .groupBy("o_custkey", month)
        .agg(F.count(F.lit(1)).cast("double").alias("orders"))
    )
    lagged = with_lags(monthly, ["o_custkey"], "date", {"orders": [1, 12]})
    return calendar_lag(lagged, ["o_custkey"], "date", "orders", 12)


# --- KPIs and report queries ---------------------------------------------------------------------


@query
def kpi_latest(spark: SparkSession, d: str) -> DataFrame:
    at_last_date = [m for m in kpis.MEASURES if m.flag is None]
    return kpis.kpi_values(_national_marts(spark, d), at_last_date)


@query
def kpi_flagged(spark: SparkSession, d: str) -> DataFrame:
    under_flag = [m for m in kpis.MEASURES if m.flag is not None]
    wanted = {"state": _state(spark, d), "industry": _industry(spark, d), "ftpt": _ftpt(spark, d)}
    return kpis.kpi_values(wanted, under_flag)


@query
def kpi_labels(spark: SparkSession, d: str) -> DataFrame:
    return kpis.kpi_texts(kpis.kpi_values(_all_marts(spark, d)))


@query
def kpi_sliced(spark: SparkSession, d: str) -> DataFrame:
    """The date slicer moves what is latest."""
    rows = S.slice_dates(_national(spark, d), dt.date(1996, 1, 1), dt.date(1999, 6, 30))
    return S.latest_value(rows, ["unemployment_rate_pct", "employed_yoy_change_pct"])


@query
def kpi_by_region(spark: SparkSession, d: str) -> DataFrame:
    return S.flagged_value(
        _state(spark, d),
        "is_latest_month",
        ["unemployment_rate_pct", "employed_thousands"],
        by="region_name",
    )


@query
def calendar_join(spark: SparkSession, d: str) -> DataFrame:
    joined = S.with_calendar(_national(spark, d), _days(spark, d))
    return joined.select(
        "date", "unemployment_rate_pct", "year", "month_number", "month_year", "quarter",
        "financial_year", "financial_year_sort", "is_first_of_month",
    )


@query
def chart_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Averages of rates and sums of levels by region, one region left out."""
    return S.chart_query(
        _state(spark, d),
        "region_name",
        ["unemployment_rate_pct", "employed_thousands"],
        filters=[("region_code", ["5"], True)],
        sort="desc",
    )


@query
def percent_of_total(spark: SparkSession, d: str) -> DataFrame:
    return pages.employment_by_sex(_ftpt(spark, d))


@query
def page_overview(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_overview(_national(spark, d), dt.date(1996, 1, 1), dt.date(2000, 12, 31))


@query
def page_state(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_state(_state(spark, d))


@query
def page_industry(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_industry(_industry(spark, d))


@query
def industry_detail(spark: SparkSession, d: str) -> DataFrame:
    return pages.industry_detail(_industry(spark, d))


@query
def page_ftpt(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_ftpt(_ftpt(spark, d))


@query
def trailing_years(spark: SparkSession, d: str) -> DataFrame:
    return S.trailing_years(_national(spark, d), 3).select("date", "unemployment_rate_pct")


@query
def latest_row(spark: SparkSession, d: str) -> DataFrame:
    row = S.to_millions(S.latest_row(_national(spark, d)), ["employed_thousands"])
    rate_change, level_change = "unemployment_rate_mom_change_ppt", "employed_mom_change_pct"
    rate = delta_status(F.col(rate_change), good_down=True)
    level = delta_status(F.col(level_change))
    return row.select(
        "date",
        "employed_millions",
        rate["direction"].alias("rate_direction"),
        rate["verdict"].alias("rate_verdict"),
        level["direction"].alias("employed_direction"),
        level["verdict"].alias("employed_verdict"),
    )


@query
def state_comparison(spark: SparkSession, d: str) -> DataFrame:
    return pages.state_comparison(_state(spark, d))


@query
def share_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return pages.share_crosstab(_ftpt(spark, d))


@query
def share_crosstab_totals(spark: SparkSession, d: str) -> DataFrame:
    return pages.share_crosstab_totals(_ftpt(spark, d))


@query
def state_totals(spark: SparkSession, d: str) -> DataFrame:
    return pages.state_totals(_state(spark, d))


@query
def slicer_financial_years(spark: SparkSession, d: str) -> DataFrame:
    """Two financial years picked on the calendar, and what all four marts then show."""
    return pages.sliced_totals(S.slice_calendar(_all_marts(spark, d), _days(spark, d), {"financial_year": SLICED_YEARS}))


@query
def ftpt_by_sex(spark: SparkSession, d: str) -> DataFrame:
    return pages.ftpt_by_sex(_ftpt(spark, d), 3)


@query
def typed_export(spark: SparkSession, d: str) -> DataFrame:
    """The industry mart as the text of an export, typed again by the names of its columns."""
    mart = _industry(spark, d)
    return S.type_by_name(mart.select(*[F.col(c).cast("string").alias(c) for c in mart.columns]))


# --- Gap analysis --------------------------------------------------------------------------------


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    return A.with_gap(A.widen(_ftpt(spark, d)))


def _figures(spark: SparkSession, d: str) -> DataFrame:
    return gap_report.figures(_ftpt(spark, d), ERA_YEARS, ERA_YEARS[0], ERA_YEARS[1])


@query
def widen_gap(spark: SparkSession, d: str) -> DataFrame:
    gaps = _gaps(spark, d)
    return gaps.withColumn("gap", round_half_up(F.col("gap"), 6))


@query
def peak_gap(spark: SparkSession, d: str) -> DataFrame:
    return A.arg_extreme(A.with_gap(A.widen(_ftpt(spark, d))), "gap", "date", "max")


@query
def centred_mean(spark: SparkSession, d: str) -> DataFrame:
    return _gaps(spark, d).select("date", A.centred_mean("female_share", "date").alias("smooth"))


@query
def headline(spark: SparkSession, d: str) -> DataFrame:
    return _figures(spark, d).select("headline.*")


@query
def turning_point(spark: SparkSession, d: str) -> DataFrame:
    return _figures(spark, d).select("turning_point.*")


@query
def era_changes(spark: SparkSession, d: str) -> DataFrame:
    return _figures(spark, d).select(F.inline("eras"))


@query
def contribution(spark: SparkSession, d: str) -> DataFrame:
    periods = F.array("before_turn", "after_turn", "since_1995_naive")
    return _figures(spark, d).select(F.inline(periods))


@query
def levels_and_pace(spark: SparkSession, d: str) -> DataFrame:
    return _figures(spark, d).select("levels.*", "male_parttime.*", "pace.*")


@query
def index_to_base(spark: SparkSession, d: str) -> DataFrame:
    wide = A.widen(_ftpt(spark, d))
    return wide.select(
        "date",
        A.index_to_base(wide, "male_ft").alias("male_index"),
        A.index_to_base(wide, "female_ft").alias("female_index"),
    )


@query
def gap_at_date(spark: SparkSession, d: str) -> DataFrame:
    found = A.at_date(_gaps(spark, d), dt.date(1996, 1, 1))
    return found.select("date", "male_share", "female_share", round_half_up(F.col("gap"), 6).alias("gap"))


@query
def figures_json(spark: SparkSession, d: str) -> DataFrame:
    return gap_report.figures_json(_figures(spark, d))


# --- Data quality --------------------------------------------------------------------------------


@query
def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    return Q.failing_not_null(B.lf_observations(spark, d), "obs_value")


@query
def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    return Q.failing_unique(B.table(spark, d, "lineitem"), "l_orderkey")


@query
def dq_accepted(spark: SparkSession, d: str) -> DataFrame:
    """Return flags other than A and N on lines that are already final."""
    lines = B.table(spark, d, "lineitem")
    return Q.failing_accepted(lines, "l_returnflag", ["A", "N"], F.col("l_linestatus") == "F")


@query
def dq_fk(spark: SparkSession, d: str) -> DataFrame:
    """Industries that are not in the code list, which every sub-division is."""
    codes = B.brand_codes(B.table(spark, d, "part"))
    return Q.failing_fk(B.account_observations(spark, d), "labouracct_ind", codes, "industry_code")


@query
def dq_grain(spark: SparkSession, d: str) -> DataFrame:
    return Q.failing_grain(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Q.failing_coverage(_state(spark, d), "date", "region_code", B.REGIONS)


@query
def dq_coverage_observed(spark: SparkSession, d: str) -> DataFrame:
    """Months in which a region has no observation at all, before marts drop incomplete rows."""
    observed = typed_observations(B.lf_observations(spark, d, [B.STATE_EXTRACT]))
    return Q.failing_coverage(observed, "period_date", "region_code", B.REGIONS)


@query
def dq_coverage_days(spark: SparkSession, d: str) -> DataFrame:
    """Days on which not every order priority occurs."""
    return Q.failing_coverage(B.table(spark, d, "orders"), "o_orderdate", "o_orderpriority", 5)


@query
def dq_coverage_grid(spark: SparkSession, d: str) -> DataFrame:
    """Months and states of the code list without an observation, states that never occur included."""
    observed = typed_observations(B.lf_observations(spark, d, [B.STATE_EXTRACT]))
    states = load_seed(spark, "seed_region").filter("geography_level <> 'National'")
    return Q.missing_members(observed, "period_date", "region_code", states, "region_code")


@query
def dq_coverage_grid_days(spark: SparkSession, d: str) -> DataFrame:
    """Days and order priorities without an order, days without any order included."""
    orders = B.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
    return Q.missing_members(orders, "day", "o_orderpriority", orders, "o_orderpriority", "1 day")


@query
def dq_basis(spark: SparkSession, d: str) -> DataFrame:
    """The check as declared, which cannot fail, and over what feeds a national comparison."""
    fact, series = _star(spark, d, B.LF_EXTRACTS)
    declared = Q.failing_mixed_basis(Q.comparison_series(series, marts.STATES))
    feeding = Q.failing_mixed_basis(Q.feeding_series(fact, series, marts.NATIONAL))
    return declared.withColumn("comparison", F.lit("states")).unionByName(
        feeding.withColumn("comparison", F.lit("national"))
    )


@query
def dq_overlap(spark: SparkSession, d: str) -> DataFrame:
    return Q.failing_overlap(
        B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity"
    )


@query
def dq_report(spark: SparkSession, d: str) -> DataFrame:
    """All declared checks of the staging layer, with the number of failures of each."""
    staged = stg_observations(B.lf_observations(spark, d), B.account_observations(spark, d))
    seeds = {name: load_seed(spark, name) for name in ("seed_measure", "seed_region")}
    return Q.run_checks(staged, CHECKS["stg_labour_force"], seeds)


@query
def diff_tables(spark: SparkSession, d: str) -> DataFrame:
    """Two builds of the order lines: all of them, and the finished ones with a new quantity."""
    lines = dedupe(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"])
    other = _other_build(lines)
    return Q.diff_tables(lines, other, ["l_orderkey", "l_linenumber"])


@query
def diff_builds(spark: SparkSession, d: str) -> DataFrame:
    """Two builds with repeated keys, of which the second has fewer rows, no tax and a new column."""
    lines = B.table(spark, d, "lineitem")
    other = _other_build(lines).drop("l_tax").withColumn("l_net", F.lit(0.0))
    return Q.diff_builds(lines, other, ["l_orderkey", "l_linenumber"])


@query
def diff_builds_by_digest(spark: SparkSession, d: str) -> DataFrame:
    """Two builds of the order lines that differ in few ranges of orders: the fullest lines are corrected."""
    lines = dedupe(B.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"])
    corrected = (F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08)
    quantity = F.when(corrected, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    other = lines.withColumn("l_quantity", quantity)
    return Q.diff_builds(lines, other, ["l_orderkey", "l_linenumber"], digests=True)


def _other_build(lines: DataFrame) -> DataFrame:
    quantity = F.when(F.col("l_quantity") < 10, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return lines.filter(F.col("l_linestatus") == "F").withColumn("l_quantity", quantity)
