"""Fixed schemas: raw tables, extracts, code lists and the column contract of each mart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE, DATE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
)


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- Fixed values: dataflow codes, table names and raw columns -----------------------------

LABOUR_FORCE = "LF"
LABOUR_ACCOUNT = "ABS_LABOUR_ACCT"

LF_DIMENSIONS = ["measure", "sex", "age", "tsest", "region", "freq"]
ACCOUNT_DIMENSIONS = ["measure", "asgs_2016", "labouracct_ind", "freq"]

RAW_LF = struct_of(
    source_extract=STRING,
    dataflow=STRING,
    **{name: STRING for name in LF_DIMENSIONS},
    time_period=STRING,
    obs_value=DOUBLE,
    unit_measure=STRING,
    unit_mult=INT,
    obs_status=STRING,
)
RAW_ACCOUNT = struct_of(
    source_extract=STRING,
    dataflow=STRING,
    **{name: STRING for name in ACCOUNT_DIMENSIONS},
    time_period=STRING,
    obs_value=DOUBLE,
    unit_measure=STRING,
    unit_mult=INT,
    obs_status=STRING,
)
LF_REQUIRED = ["source_extract", *LF_DIMENSIONS, "time_period"]
ACCOUNT_REQUIRED = ["source_extract", *ACCOUNT_DIMENSIONS, "time_period"]

# The tokens that a CSV cell may hold to say "no value".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Fixed values: the extracts, each a series-key selection over one dataflow ---------------


@dataclass(frozen=True)
class Extract:
    """One named download: which series it asks for, and how many members must come back."""

    name: str
    dataflow: str
    key: str
    expect: tuple[tuple[str, int], ...] = ()


EXTRACTS = (
    Extract("national_summary", LABOUR_FORCE, "M3+M6+M12+M13+M16.3.1599.20.AUS.M"),
    Extract("national_fulltime_parttime", LABOUR_FORCE, "M1+M2+M3.1+2+3.1599.20.AUS.M"),
    Extract("state_summary", LABOUR_FORCE, "M3+M13.3.1599.30.1+2+3+4+5+6+7+8.M", (("region", 8),)),
    Extract("national_trend", LABOUR_FORCE, "M3+M13.3.1599.30.AUS.M"),
    Extract("industry_employment", LABOUR_ACCOUNT, "M9.AUS..A"),
)

# --- Fixed values: the column contract of each mart ------------------------------------------

MART_CONTRACT: dict[str, T.StructType] = {
    "v_national_overview": struct_of(
        date=DATE,
        employed_thousands=DOUBLE,
        unemployed_thousands=DOUBLE,
        unemployment_rate_pct=DOUBLE,
        participation_rate_pct=DOUBLE,
        emp_to_pop_ratio_pct=DOUBLE,
        unemployment_rate_mom_change_ppt=DOUBLE,
        employed_mom_change_pct=DOUBLE,
        unemployment_rate_yoy_change_ppt=DOUBLE,
        employed_yoy_change_pct=DOUBLE,
        is_latest_month=INT,
    ),
    "v_unemployment_by_state": struct_of(
        date=DATE,
        region_code=STRING,
        region_name=STRING,
        employed_thousands=DOUBLE,
        unemployment_rate_pct=DOUBLE,
        unemployment_rate_mom_change_ppt=DOUBLE,
        unemployment_rate_yoy_change_ppt=DOUBLE,
        employed_yoy_change_pct=DOUBLE,
        is_latest_month=INT,
    ),
    "v_fulltime_parttime": struct_of(
        date=DATE,
        sex_code=STRING,
        sex_label=STRING,
        employed_fulltime_thousands=DOUBLE,
        employed_parttime_thousands=DOUBLE,
        employed_total_thousands=DOUBLE,
        fulltime_share_pct=DOUBLE,
        parttime_share_pct=DOUBLE,
        fulltime_share_yoy_change_ppt=DOUBLE,
        employed_total_yoy_change_pct=DOUBLE,
        is_latest_month=INT,
    ),
    "v_industry_breakdown": struct_of(
        date=DATE,
        industry_code=STRING,
        industry_name=STRING,
        employed_thousands=DOUBLE,
        employed_yoy_change_thousands=DOUBLE,
        employed_yoy_change_pct=DOUBLE,
        rank_by_employment=LONG,
        growth_category=STRING,
        is_latest_year=INT,
        is_focus_industry=INT,
    ),
}
