"""The checks each table of the warehouse is declared with."""

from __future__ import annotations

from seriesmart.operators.quality import Checks
from seriesmart.schemas import LABOUR_ACCOUNT, LABOUR_FORCE
from seriesmart.sources.codelists import SEED_ROWS

# --- Fixed values: accepted members and declared checks -------------------------------------------

DATAFLOWS = [LABOUR_FORCE, LABOUR_ACCOUNT]
UNITS = ["thousands of persons", "percent"]
EMPLOYMENT_TYPES = ["Full-time", "Part-time", "Total", "Not applicable"]
SEX_NAMES = ["Male", "Female", "Persons"]
ADJUSTMENTS = ["Original", "Seasonally adjusted", "Trend"]
LEVELS = ["National", "State", "Territory"]
STATES = [name for _, name, level in SEED_ROWS["seed_region"] if level != "National"]
FLAG = [0, 1]

CHECKS: dict[str, Checks] = {
    "seed_measure": Checks(
        not_null=["measure_code", "measure_name"],
        unique=["measure_code"],
        accepted={"measure_unit": UNITS, "employment_type": EMPLOYMENT_TYPES},
    ),
    "seed_region": Checks(
        not_null=["region_code", "region_name"],
        unique=["region_code", "region_name"],
        accepted={"geography_level": LEVELS},
    ),
    "seed_sex": Checks(
        not_null=["sex_code", "sex_name"], unique=["sex_code"], accepted={"sex_name": SEX_NAMES}
    ),
    "seed_adjustment_type": Checks(
        not_null=["tsest_code", "adjustment_type"],
        unique=["tsest_code"],
        accepted={"adjustment_type": ADJUSTMENTS},
    ),
    "seed_industry_division": Checks(
        not_null=["industry_code", "industry_name"], unique=["industry_code", "industry_name"]
    ),
    "lf_observations": Checks(
        not_null=["source_extract", "measure", "sex", "tsest", "region", "time_period"]
    ),
    "labour_account_observations": Checks(
        not_null=["source_extract", "measure", "labouracct_ind", "time_period"]
    ),
    "stg_labour_force": Checks(
        grain=["series_id", "period_date"],
        not_null=[
            "series_id", "period_date", "source_dataflow", "source_extract", "measure_code",
            "region_code", "frequency_code", "obs_value",
        ],
        accepted={
            "source_dataflow": DATAFLOWS,
            "sex_code": ["1", "2", "3"],
            "tsest_code": ["10", "20", "30"],
            "frequency_code": ["M", "A"],
        },
        references={
            "measure_code": ("seed_measure", "measure_code"),
            "region_code": ("seed_region", "region_code"),
        },
    ),
    "dim_date": Checks(
        not_null=[
            "date_key", "year", "month_number", "month_name", "month_year", "financial_year",
        ],
        unique=["date_key"],
        accepted={"month_number": list(range(1, 13)), "quarter": ["Q1", "Q2", "Q3", "Q4"]},
    ),
    "dim_series": Checks(
        not_null=[
            "series_id", "source_dataflow", "measure_code", "measure_name", "measure_unit",
            "employment_type", "sex_name", "adjustment_type", "region_code", "region_name",
            "geography_level", "frequency_code",
        ],
        unique=["series_id"],
        accepted={
            "source_dataflow": DATAFLOWS,
            "measure_unit": UNITS,
            "employment_type": EMPLOYMENT_TYPES,
            "sex_name": [*SEX_NAMES, "Not applicable"],
            "adjustment_type": [*ADJUSTMENTS, "Not applicable"],
            "geography_level": [*LEVELS, "Unknown"],
            "frequency": ["Monthly", "Annual", "Unknown"],
        },
    ),
    "fct_labour_force": Checks(
        grain=["series_id", "date_key"],
        not_null=["series_period_key", "series_id", "date_key", "obs_value", "source_extract"],
        unique=["series_period_key"],
        references={
            "series_id": ("dim_series", "series_id"),
            "date_key": ("dim_date", "date_key"),
        },
    ),
    "v_national_overview": Checks(
        not_null=["date", "employed_thousands", "unemployment_rate_pct"],
        unique=["date"],
        accepted={"is_latest_month": FLAG},
    ),
    "v_unemployment_by_state": Checks(
        grain=["date", "region_code"],
        not_null=["date", "region_code", "region_name", "employed_thousands", "unemployment_rate_pct"],
        accepted={"region_name": STATES, "is_latest_month": FLAG},
    ),
    "v_fulltime_parttime": Checks(
        grain=["date", "sex_code"],
        not_null=[
            "date", "sex_code", "sex_label", "employed_fulltime_thousands",
            "employed_parttime_thousands", "employed_total_thousands", "fulltime_share_pct",
            "parttime_share_pct",
        ],
        accepted={"sex_code": ["1", "2", "3"], "sex_label": SEX_NAMES, "is_latest_month": FLAG},
    ),
    "v_industry_breakdown": Checks(
        grain=["date", "industry_code"],
        not_null=[
            "date", "industry_code", "industry_name", "employed_thousands", "rank_by_employment",
            "growth_category",
        ],
        accepted={
            "growth_category": ["Growing", "Shrinking", "Stable"],
            "is_latest_year": FLAG,
            "is_focus_industry": FLAG,
        },
        references={"industry_code": ("seed_industry_division", "industry_code")},
    ),
}
