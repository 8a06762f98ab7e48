"""Code lists: the labels behind the dimension codes of an observation."""

from __future__ import annotations

from dataclasses import dataclass
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesmart.schemas import INT, STRING, struct_of

# --- Fixed values: the five code lists -------------------------------------------------------

SEED_ROWS: dict[str, list[tuple]] = {
    "seed_measure": [
        ("M1", "Employed full-time", "thousands of persons", "Full-time"),
        ("M2", "Employed part-time", "thousands of persons", "Part-time"),
        ("M3", "Employed total", "thousands of persons", "Total"),
        ("M6", "Unemployed", "thousands of persons", "Not applicable"),
        ("M9", "Employed persons (jobs-based)", "thousands of persons", "Total"),
        ("M12", "Participation rate", "percent", "Not applicable"),
        ("M13", "Unemployment rate", "percent", "Not applicable"),
        ("M16", "Employment-to-population ratio", "percent", "Not applicable"),
    ],
    "seed_sex": [("1", "Male"), ("2", "Female"), ("3", "Persons")],
    "seed_adjustment_type": [
        ("10", "Original", 0),
        ("20", "Seasonally adjusted", 1),
        ("30", "Trend", 0),
    ],
    "seed_region": [
        ("AUS", "Australia", "National"),
        ("1", "New South Wales", "State"),
        ("2", "Victoria", "State"),
        ("3", "Queensland", "State"),
        ("4", "South Australia", "State"),
        ("5", "Western Australia", "State"),
        ("6", "Tasmania", "State"),
        ("7", "Northern Territory", "Territory"),
        ("8", "Australian Capital Territory", "Territory"),
    ],
    "seed_industry_division": [
        ("A", "Agriculture, Forestry & Fishing", 1, 0),
        ("B", "Mining", 1, 0),
        ("C", "Manufacturing", 1, 0),
        ("D", "Electricity, Gas, Water & Waste", 1, 0),
        ("E", "Construction", 1, 1),
        ("F", "Wholesale Trade", 1, 0),
        ("G", "Retail Trade", 1, 1),
        ("H", "Accommodation & Food Services", 1, 0),
        ("I", "Transport, Postal & Warehousing", 1, 0),
        ("J", "Information Media & Telecommunications", 1, 1),
        ("K", "Financial & Insurance Services", 1, 0),
        ("L", "Rental, Hiring & Real Estate", 1, 0),
        ("M", "Professional, Scientific & Technical", 1, 0),
        ("N", "Administrative & Support Services", 1, 0),
        ("O", "Public Administration & Safety", 1, 0),
        ("P", "Education & Training", 1, 0),
        ("Q", "Health Care & Social Assistance", 1, 1),
        ("R", "Arts & Recreation Services", 1, 0),
        ("S", "Other Services", 1, 0),
        ("TOTAL", "All Industries", 0, 0),
    ],
}

SEED_SCHEMAS: dict[str, T.StructType] = {
    "seed_measure": struct_of(
        measure_code=STRING, measure_name=STRING, measure_unit=STRING, employment_type=STRING
    ),
    "seed_sex": struct_of(sex_code=STRING, sex_name=STRING),
    "seed_adjustment_type": struct_of(
        tsest_code=STRING, adjustment_type=STRING, is_seasonally_adjusted=INT
    ),
    "seed_region": struct_of(region_code=STRING, region_name=STRING, geography_level=STRING),
    "seed_industry_division": struct_of(
        industry_code=STRING, industry_name=STRING, is_division=INT, is_focus_industry=INT
    ),
}


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few literal rows. Arrow makes them a local relation, whose size the optimizer knows, so a
    join with them is broadcast without a hint."""
    columns = dict(zip(schema.fieldNames(), zip(*rows)))
    return spark.createDataFrame(pa.table(columns)).to(schema)


# The code lists already made, by session; they are literals and never change.
_LOADED: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def load_seed(spark: SparkSession, name: str) -> DataFrame:
    """One code list with its declared column types."""
    loaded = _LOADED.setdefault(spark, {})
    if name not in loaded:
        loaded[name] = local_rows(spark, SEED_ROWS[name], SEED_SCHEMAS[name])
    return loaded[name]


@dataclass(frozen=True)
class CodeLists:
    """The code lists a series dimension is decoded with; any of them may be replaced."""

    measure: DataFrame
    sex: DataFrame
    adjustment: DataFrame
    region: DataFrame
    industry: DataFrame

    @classmethod
    def standard(cls, spark: SparkSession, **replaced: DataFrame) -> CodeLists:
        lists = {
            "measure": "seed_measure",
            "sex": "seed_sex",
            "adjustment": "seed_adjustment_type",
            "region": "seed_region",
            "industry": "seed_industry_division",
        }
        return cls(
            **{
                part: replaced[part] if part in replaced else load_seed(spark, name)
                for part, name in lists.items()
            }
        )
