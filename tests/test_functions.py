from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seriesmart.functions import keys, labels, numbers


def one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_round_half_even_is_python_round(spark):
    rng = random.Random(7)
    values = [rng.randint(-10**6, 10**6) / 1000 for _ in range(4000)]
    values += [0.25, 0.75, 2.5, 3.5, -0.04, 0.05, 0.15, 0.35, 1.005, 2.675, 12345.65]
    for digits in (0, 1, 2):
        got = one(spark, [(v,) for v in values], "v double", numbers.round_half_even(F.col("v"), digits))
        assert got == [round(v, digits) + 0.0 for v in values]


def test_round_half_up_goes_away_from_zero(spark):
    got = one(spark, [(1.005,), (-1.005,), (2.5,), (0.125,)], "v double", numbers.round_half_up(F.col("v"), 2))
    assert got == [1.01, -1.01, 2.5, 0.13]


def test_changes_divide_unrounded_and_survive_zero(spark):
    rows = [(101.0, 100.0), (1.0, 0.0), (None, 3.0), (3.0, None)]
    got = one(spark, rows, "a double, b double", numbers.pct_change(F.col("a"), F.col("b")))
    assert got == [1.0, None, None, None]


def test_growth_bands_include_their_limits(spark):
    rows = [(2.0,), (1.99,), (-2.0,), (-1.99,), (None,)]
    got = one(spark, rows, "c double", numbers.growth_category(F.col("c")))
    assert got == ["Growing", "Stable", "Shrinking", "Stable", "Stable"]


def test_exact_sum_ignores_partitioning(spark):
    values = [(0.1,)] * 1000 + [(1e9,)] * 3
    sums = {
        spark.createDataFrame(values, "v double").repartition(n).agg(numbers.exact_sum(F.col("v"))).first()[0]
        for n in (1, 3, 7, 16)
    }
    assert sums == {3000000100.0}


def test_series_key_is_null_when_a_code_is(spark):
    rows = [("M3", "3"), ("M3", None)]
    got = one(spark, rows, "measure string, sex string", keys.series_key("LF", ["measure", "sex"]))
    assert got == ["LF.M3.3", None]


def test_periods(spark):
    got = one(spark, [("2015-07",), ("2019",), ("2019  ",)], "p string", keys.parse_period(F.col("p")))
    assert got == [dt.date(2015, 7, 1), dt.date(2019, 1, 1), dt.date(2019, 1, 1)]


@pytest.mark.parametrize("period", ["2015-13", "20155", "2015-Q1", "abcd"])
def test_bad_period_fails(spark, period):
    with pytest.raises(PySparkException):
        one(spark, [(period,)], "p string", keys.parse_period(F.col("p")))


def test_financial_year_ends_in_june(spark):
    days = [(dt.date(2023, 6, 30),), (dt.date(2023, 7, 1),), (dt.date(2024, 2, 29),)]
    got = one(spark, days, "d date", keys.financial_year_end(F.col("d")))
    assert got == [2023, 2024, 2024]


def test_change_labels(spark):
    rows = [(0.14,), (-0.25,), (0.0,), (None,), (1234.56,)]
    got = one(spark, rows, "c double", labels.change_label(F.col("c"), labels.PPT_VS_LAST_MONTH))
    assert got == [
        "▲ 0.1 ppt vs last month", "▼ 0.3 ppt vs last month", "– 0.0 ppt vs last month",
        "– 0.0 ppt vs last month", "▲ 1234.6 ppt vs last month",
    ]


def test_value_formats(spark):
    def shown(kind, *values):
        return one(spark, [(v,) for v in values], "v double", labels.format_value(F.col("v"), kind))

    assert shown("pct", 4.345, None) == ["4.35%", None]
    assert shown("signed_ppt", 0.1, -0.1, 0.0) == ["+0.10 ppt", "-0.10 ppt", "+0.00 ppt"]
    assert shown("signed_pct", 12.0) == ["+12.00%"]
    assert shown("thousands", 14201.25, 3.0) == ["14,201.3", "3.0"]


def test_delta_status(spark):
    df = spark.createDataFrame([(0.5,), (0.0,), (-0.5,), (None,)], "d double")
    rows = df.select(labels.delta_status(F.col("d"), good_down=True).alias("s")).collect()
    assert [r.s and tuple(r.s) for r in rows] == [("up", "bad"), ("up", "bad"), ("down", "good"), None]
