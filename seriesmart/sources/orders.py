"""Order tables as observations.

Orders play the monthly survey and line items the annual account, so the whole warehouse runs
over any data that has those tables: counts of orders are persons employed, order status is the
kind of employment, order priority is sex, the customer's region is the region, the part's brand
is the industry division and the part itself its sub-division.

The aggregations run on a month or year and a small code, or on the part, so a hot customer, part
or month is combined before it is shuffled. Nothing is broadcast by hint: dimension tables of
unknown size are left to adaptive execution, which also splits a hot customer in the join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.schemas import (
    INT,
    LABOUR_ACCOUNT,
    LABOUR_FORCE,
    RAW_ACCOUNT,
    RAW_LF,
    STRING,
    struct_of,
)
from seriesmart.sources.codelists import CodeLists, local_rows
from seriesmart.sources.observations import append_extracts

# Which codes of the order tables stand for which statistical codes.
# The code of what a row refers to and no table has.
UNKNOWN = "unknown"
MALE_PRIORITIES = ["1-URGENT", "2-HIGH"]
FOCUS_BRANDS = ["Brand#5", "Brand#7", "Brand#10", "Brand#17"]
REGIONS = 5
NATIONAL_EXTRACTS = ("national_summary", "national_fulltime_parttime", "national_trend")
STATE_EXTRACT = "state_summary"
LF_EXTRACTS = (*NATIONAL_EXTRACTS, STATE_EXTRACT)

# The key under which every region's monthly level and rate is selected.
STATE_KEY = "M3+M13.3.1599.30.1+2+3+4+5.M"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _month(timestamp: str) -> Column:
    return F.trunc(F.col(timestamp).cast("date"), "month")


def _status_counts() -> list[Column]:
    status = F.col("o_orderstatus")
    return [
        F.count(F.lit(1)).alias("orders"),
        *[F.count_if(status == s).alias(s) for s in ("F", "O", "P")],
    ]


def _gap_if_zero(count: str) -> Column:
    return F.nullif(F.col(count), F.lit(0)).cast("double")


def _rate(count: str) -> Column:
    return _gap_if_zero(count) * 100 / F.col("orders")


def _entry(
    extract: str, measure: str, value: Column, tsest: str, when: Column | None = None
) -> Column:
    percent = measure in ("M12", "M13", "M16")
    row = F.struct(
        F.lit(extract).alias("source_extract"),
        F.lit(measure).alias("measure"),
        F.lit(tsest).alias("tsest"),
        value.cast("double").alias("obs_value"),
        F.lit("PCT" if percent else "NUM").alias("unit_measure"),
        F.lit(0 if percent else 3).alias("unit_mult"),
    )
    return row if when is None else F.when(when, row)


def _lf_rows(cells: DataFrame, entries: list[Column]) -> DataFrame:
    """One raw row per cell and entry; ``cells`` has month, sex, region and the counts."""
    exploded = cells.select(
        "month", "sex", "region", F.explode(F.array_compact(F.array(*entries))).alias("e")
    )
    return exploded.select(
        "e.source_extract",
        F.lit(LABOUR_FORCE).alias("dataflow"),
        "e.measure",
        "sex",
        F.lit("1599").alias("age"),
        "e.tsest",
        "region",
        F.lit("M").alias("freq"),
        F.date_format("month", "yyyy-MM").alias("time_period"),
        "e.obs_value",
        "e.unit_measure",
        "e.unit_mult",
        F.lit(None).cast("string").alias("obs_status"),
    ).select(*RAW_LF.fieldNames())


def national_observations(orders: DataFrame, extracts: Iterable[str]) -> DataFrame:
    """Nation-wide extracts, all from one scan of orders."""
    sex = F.when(F.col("o_orderpriority").isin(MALE_PRIORITIES), "1").otherwise("2")
    by_sex = orders.groupBy(_month("o_orderdate").alias("month"), sex.alias("sex")).agg(
        *_status_counts()
    )
    counts = ["orders", "F", "O", "P"]
    cells = (
        by_sex.select("month", F.explode(F.array("sex", F.lit("3"))).alias("sex"), *counts)
        .groupBy("month", "sex")
        .agg(*[F.sum(c).alias(c) for c in counts])
        .withColumn("region", F.lit("AUS"))
    )
    persons = F.col("sex") == "3"
    total = F.col("orders")
    entries = {
        "national_summary": [
            _entry("national_summary", "M3", total, "20", persons),
            _entry("national_summary", "M6", _gap_if_zero("O"), "20", persons),
            _entry("national_summary", "M12", _rate("F"), "20", persons),
            _entry("national_summary", "M13", _rate("O"), "20", persons),
            _entry("national_summary", "M16", _rate("P"), "20", persons),
        ],
        "national_fulltime_parttime": [
            _entry("national_fulltime_parttime", "M1", F.col("F"), "20"),
            _entry("national_fulltime_parttime", "M2", F.col("O") + F.col("P"), "20"),
            _entry("national_fulltime_parttime", "M3", total, "20"),
        ],
        "national_trend": [
            _entry("national_trend", "M3", total, "30", persons),
            _entry("national_trend", "M13", _rate("O"), "30", persons),
        ],
    }
    return _lf_rows(cells, [e for name in extracts for e in entries[name]])


def state_observations(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Levels and rates by region of the customer.

    Orders are counted per customer and month before the join, so a hot customer is one row a month.
    Orders without a known customer or nation have a region of their own.
    """
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", (F.col("n_regionkey") + 1).cast("string").alias("region")
    )
    counted = orders.groupBy("o_custkey", _month("o_orderdate").alias("month")).agg(*_status_counts())
    cells = (
        counted.join(home, F.col("o_custkey") == F.col("c_custkey"), "left")
        .groupBy("month", F.coalesce("region", F.lit(UNKNOWN)).alias("region"))
        .agg(*[F.sum(c).alias(c) for c in ("orders", "F", "O", "P")])
        .withColumn("sex", F.lit("3"))
    )
    entries = [
        _entry(STATE_EXTRACT, "M3", F.col("orders"), "30"),
        _entry(STATE_EXTRACT, "M13", _rate("O"), "30"),
    ]
    return _lf_rows(cells, entries)


def lf_observations(
    spark: SparkSession, directory: str, extracts: Iterable[str] = LF_EXTRACTS
) -> DataFrame:
    """The monthly raw table, limited to the extracts that are asked for."""
    extracts = list(extracts)
    orders = table(spark, directory, "orders")
    national = [e for e in extracts if e in NATIONAL_EXTRACTS]
    parts = []
    if national:
        parts.append(national_observations(orders, national))
    if STATE_EXTRACT in extracts:
        customer, nation = table(spark, directory, "customer"), table(spark, directory, "nation")
        parts.append(state_observations(orders, customer, nation))
    return append_extracts(parts)


def account_observations(spark: SparkSession, directory: str) -> DataFrame:
    """The annual raw table: quantity shipped per part, per brand and in total.

    Line items are summed per part and year before the join with parts. Each of those rows then
    counts for its part, its brand and the total in one aggregation, so parts are read once.
    """
    shipped = (
        table(spark, directory, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("year"))
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,4)")).alias("obs_value"))
    )
    part = table(spark, directory, "part").select("p_partkey", "p_brand")
    # Items of an unknown part are a brand of their own, so that the levels add up.
    brand = F.coalesce("p_brand", F.lit(UNKNOWN))
    number = F.coalesce(F.col("l_partkey").cast("string"), F.lit(UNKNOWN))
    codes = F.array(F.concat(brand, F.lit("."), number), brand, F.lit("TOTAL"))
    by_code = (
        shipped.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(F.explode(codes).alias("labouracct_ind"), "year", "obs_value")
        .groupBy("labouracct_ind", "year")
        .agg(F.sum("obs_value").alias("obs_value"))
    )
    constants = {
        "source_extract": "industry_employment",
        "dataflow": LABOUR_ACCOUNT,
        "measure": "M9",
        "asgs_2016": "AUS",
        "freq": "A",
        "unit_measure": "NUM",
        "unit_mult": 3,
    }
    return (
        by_code.withColumn("obs_value", F.col("obs_value").cast("double"))
        .withColumns({c: F.lit(v) for c, v in constants.items()})
        .withColumn("time_period", F.col("year").cast("string"))
        .withColumn("obs_status", F.lit(None).cast("string"))
        .select(*RAW_ACCOUNT.fieldNames())
    )


def brand_codes(part: DataFrame) -> DataFrame:
    """The industry code list of the order tables: one division per brand, and the total."""
    brands = (
        part.select(F.col("p_brand").alias("industry_code"))
        .distinct()
        .select(
            "industry_code",
            F.concat(F.lit("Division "), F.substring_index("industry_code", "#", -1)).alias(
                "industry_name"
            ),
            F.lit(1).alias("is_division"),
            F.col("industry_code").isin(FOCUS_BRANDS).cast("int").alias("is_focus_industry"),
        )
    )
    total = local_rows(
        part.sparkSession,
        [("TOTAL", "All Industries", 0, 0)],
        struct_of(industry_code=STRING, industry_name=STRING, is_division=INT, is_focus_industry=INT),
    )
    return brands.unionByName(total)


def code_lists(spark: SparkSession, directory: str) -> CodeLists:
    """The standard code lists with brands for industries."""
    return CodeLists.standard(spark, industry=brand_codes(table(spark, directory, "part")))
