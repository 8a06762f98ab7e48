"""The gap analysis against plain pandas on an invented series of 30 years."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmart.operators import analysis as A
from seriesmart.plans import gap_report

MONTHS = pd.date_range("1981-02-01", "2011-09-01", freq="MS")


def invented() -> pd.DataFrame:
    """Men fall slowly; women fall until 1999 and recover."""
    i = np.arange(len(MONTHS))
    turn = 215
    share = {
        "Male": np.round(90 - i * 0.02 + np.sin(i / 5), 2),
        "Female": np.round(60 - 0.03 * np.minimum(i, turn) + 0.05 * np.maximum(i - turn, 0) + np.cos(i / 3) / 2, 2),
    }
    total = {"Male": 4000 + 3.0 * i, "Female": 2500 + 5.0 * i}
    parts = []
    for sex in ("Male", "Female"):
        full = np.round(total[sex] * share[sex] / 100, 1)
        parts.append(pd.DataFrame({
            "date": MONTHS.date, "sex_label": sex, "employed_fulltime_thousands": full,
            "employed_parttime_thousands": np.round(total[sex] - full, 1),
            "employed_total_thousands": total[sex], "fulltime_share_pct": share[sex],
        }))
    both = parts[0].copy()
    both["sex_label"] = "Persons"
    for c in ("employed_fulltime_thousands", "employed_parttime_thousands", "employed_total_thousands"):
        both[c] = parts[0][c] + parts[1][c]
    both["fulltime_share_pct"] = (
        both.employed_fulltime_thousands / both.employed_total_thousands * 100
    ).round(2)
    return pd.concat([*parts, both])


@pytest.fixture(scope="module")
def frame():
    return invented()


@pytest.fixture(scope="module")
def mart(spark, frame):
    return spark.createDataFrame(frame).repartition(7)


@pytest.fixture(scope="module")
def series(frame):
    """One pandas series per (sex, value)."""
    wide = frame.set_index(["date", "sex_label"]).unstack("sex_label")
    wide.index = pd.to_datetime(wide.index)
    return {(sex, name): wide[column][sex] for sex in ("Male", "Female") for name, column in A.VALUES.items()}


@pytest.fixture(scope="module")
def gap(series):
    return series["Male", "share"] - series["Female", "share"]


@pytest.fixture(scope="module")
def figures(mart):
    return gap_report.figures(mart, [1981, 1990, 2000], 1990, 2000).first()


def in_year(values: pd.Series, year: int) -> float:
    hits = values[values.index.year == year]
    return hits.iloc[-1] if year == values.index[-1].year else hits.iloc[0]


def test_widen_and_gap(mart, gap):
    got = A.with_gap(A.widen(mart)).orderBy("date").toPandas()
    assert np.allclose(got.gap, gap.values)


def test_centred_mean_equals_a_centred_rolling_mean(mart, series):
    wide = A.widen(mart)
    got = wide.select("date", A.centred_mean("female_share", "date").alias("m")).orderBy("date").toPandas()
    expected = series["Female", "share"].rolling(12, center=True).mean()
    assert np.allclose(got.m.astype(float), expected.values, equal_nan=True)
    assert got.m.isna().sum() == 11


def test_extremes_take_the_first_of_ties(spark):
    rows = [(dt.date(2000, m, 1), v) for m, v in ((1, 1.0), (2, 5.0), (3, 5.0), (4, None), (5, 1.0))]
    df = spark.createDataFrame(rows, "date date, v double")
    assert tuple(A.arg_extreme(df, "v", "date", "max").first()) == (5.0, dt.date(2000, 2, 1))
    assert tuple(A.arg_extreme(df, "v", "date", "min").first()) == (1.0, dt.date(2000, 1, 1))


def test_headline_and_turning_point(figures, gap, series):
    h, t = figures.headline, figures.turning_point
    assert h.gap_now == round(gap.iloc[-1], 1) and h.gap_start == round(gap.iloc[0], 1)
    assert h.gap_peak == round(gap.max(), 1) and h.gap_peak_date == gap.idxmax().date()
    women = series["Female", "share"]
    smooth = women.rolling(12, center=True).mean()
    assert t.date == smooth.idxmin().date()
    assert t.female_share_at_trough == round(smooth.min(), 1)
    assert t.recovery_ppt == round(women.iloc[-1] - smooth.min(), 1)
    assert t.years_of_decline_before == smooth.idxmin().year - 1981


def test_eras_run_through_the_turn(figures, series):
    men, women = series["Male", "share"], series["Female", "share"]
    turn = figures.turning_point.date.year
    years = [1981, 1990, min(2000, turn), turn, 2011]
    expected = []
    for a, b in zip(years, years[1:]):
        if a == b:
            continue
        dm, dw = in_year(men, b) - in_year(men, a), in_year(women, b) - in_year(women, a)
        length = (dt.date(b, 1, 1) - dt.date(a, 1, 1)).days / 365.25
        expected.append((f"{a}–{b}", round(dm, 1), round(dw, 1), round(dm - dw, 1), round((dm - dw) / length * 10, 1)))
    assert [tuple(e) for e in figures.eras] == expected


def test_contributions_use_sizes(figures, series):
    men, women = series["Male", "share"], series["Female", "share"]
    turn = figures.turning_point.date.year
    for block, a, b in (("before_turn", 1990, turn), ("after_turn", turn, 2011), ("since_1990_naive", 1990, 2011)):
        c = figures[block]
        dm, dw = in_year(men, b) - in_year(men, a), in_year(women, b) - in_year(women, a)
        assert c.period == f"{a}–{b}"
        assert c.gap_change_ppt == round(dm - dw, 1)
        assert c.from_men_pct == round(abs(dm) / (abs(dm) + abs(dw)) * 100)
        assert c.from_men_pct + c.from_women_pct == 100


def test_levels(figures, series):
    women, men = series["Female", "ft"], series["Male", "ft"]
    lv = figures.levels
    assert lv.female_ft_start == round(women.iloc[0]) and lv.female_ft_now == round(women.iloc[-1])
    assert lv.female_ft_growth_pct == round((women.iloc[-1] / women.iloc[0] - 1) * 100)
    assert lv.male_ft_growth_pct == round((men.iloc[-1] / men.iloc[0] - 1) * 100)
    assert lv.women_share_of_ft_jobs_now == round(women.iloc[-1] / (women.iloc[-1] + men.iloc[-1]) * 100, 1)
    part = series["Male", "pt"] / series["Male", "tot"] * 100
    assert figures.male_parttime.start_pct == round(part.iloc[0], 1)


def test_pace_is_the_least_squares_slope(figures, gap):
    recent = gap["2000":]
    x = np.array([(d - recent.index[0]).days for d in recent.index]) / 365.25
    slope = np.polyfit(x, recent.values, 1)[0]
    years = round(gap.iloc[-1] / abs(slope))
    assert slope < 0
    assert tuple(figures.pace) == (round(slope * 10, 1), years, 2011 + years)


def test_pace_says_nothing_when_the_gap_widens(spark):
    rows = [
        (dt.date(2010 + i // 12, i % 12 + 1, 1), s, 1.0, 1.0, 2.0, 50.0 + (i if s == "Male" else 0))
        for i in range(24) for s in ("Male", "Female")
    ]
    df = spark.createDataFrame(rows, ["date", "sex_label", *A.VALUES.values()])
    pace = gap_report.figures(df, [2010], 2010, 2010).first().pace
    assert pace.years_to_parity_at_that_pace is None and pace.parity_year_at_that_pace is None


def test_unknown_contribution_when_nothing_moves(spark):
    rows = [(dt.date(2010 + i // 12, i % 12 + 1, 1), s, 1.0, 1.0, 2.0, 50.0) for i in range(36) for s in ("Male", "Female")]
    df = spark.createDataFrame(rows, ["date", "sex_label", *A.VALUES.values()])
    c = gap_report.figures(df, [2010], 2010, 2010).first().since_2010_naive
    assert (c.gap_change_ppt, c.from_men_pct, c.from_women_pct) == (0.0, None, None)


def test_index_to_base(mart, series):
    wide = A.widen(mart)
    got = wide.select("date", A.index_to_base(wide, "male_ft").alias("i")).orderBy("date").toPandas()
    men = series["Male", "ft"]
    assert np.allclose(got.i, men / men.iloc[0] * 100)
    assert got.i[0] == 100.0
    assert not math.isnan(got.i.iloc[-1])


def test_point_lookup(mart, series):
    day = dt.date(1996, 1, 1)
    (row,) = A.at_date(A.widen(mart), day).select("date", F.col("male_share")).collect()
    assert row.male_share == series["Male", "share"][pd.Timestamp(day)]
