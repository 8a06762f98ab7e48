"""Turning point and decomposition of the gap between two members.

The input is a mart of one row per month and member, so everything after it is as long as the
calendar. All scalar figures come from one aggregate, the profile, and are projections of its row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmart.functions.numbers import percent_of, round_half_even

VALUES = {
    "ft": "employed_fulltime_thousands",
    "pt": "employed_parttime_thousands",
    "tot": "employed_total_thousands",
    "share": "fulltime_share_pct",
}
MEMBERS = ["Male", "Female", "Persons"]


def widen(
    df: DataFrame,
    key: str = "date",
    member: str = "sex_label",
    members: list[str] = MEMBERS,
    values: dict[str, str] = VALUES,
) -> DataFrame:
    """One row per key, one column ``<member>_<value>`` each; two rows for one cell fail."""
    cells = []
    for m in members:
        here = F.col(member) == m
        twice = F.raise_error(F.concat(F.lit(f"more than one row for {m} on "), F.max(key).cast("string")))
        for name, column in values.items():
            cell = F.when(F.count_if(here) > 1, twice.cast("double")).otherwise(
                F.max(F.when(here, F.col(column)))
            )
            cells.append(cell.alias(f"{m.lower()}_{name}"))
    return df.groupBy(key).agg(*cells)


def with_gap(wide: DataFrame, value: str = "share") -> DataFrame:
    return wide.withColumn("gap", F.col(f"male_{value}") - F.col(f"female_{value}"))


def arg_extreme(df: DataFrame, column: str, date: str, kind: str = "max") -> DataFrame:
    """The extreme value of a column and its date, the first one on ties."""
    value, day = F.col(column), F.col(date)
    sign = -1 if kind == "max" else 1
    first = F.min(F.when(value.isNotNull(), F.struct((value * sign).alias("order"), day.alias("day"))))
    return df.agg((first["order"] * sign).alias(column), first["day"].alias(date))


def centred_mean(column: str, date: str, width: int = 12) -> Column:
    """Mean of ``width`` rows around each row, null at the ends where some are missing.

    An even window reaches one row further back than ahead. Summed as decimals, so equal windows
    have equal means.
    """
    back = width // 2
    window = W.orderBy(date).rowsBetween(-back, width - 1 - back)
    total = F.sum(F.col(column).cast("decimal(28,6)")).over(window)
    complete = F.count(column).over(window) == width
    return F.when(complete, total.cast("double") / width)


def index_to_base(df: DataFrame, column: str, date: str = "date") -> Column:
    """The column in percent of its value on the first date."""
    first = df.agg(F.min(F.struct(date, *[c for c in df.columns if c != date])).alias("first"))
    return F.col(column) / first.select(F.col(f"first.{column}")).scalar() * 100


def at_date(df: DataFrame, day: dt.date, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) == F.lit(day))


def profile(gaps: DataFrame, from_year: int = 2010, date: str = "date") -> DataFrame:
    """One row: first and last month, the first month of each year, peak, trough and trend.

    ``gaps`` is the widened mart with its gap, one row per month, which bounds both the window and
    the list of years.
    """
    day = F.col(date)
    columns = [c for c in gaps.columns if c != date]
    year = F.year(day)
    marked = gaps.withColumns(
        {
            "smooth": centred_mean("female_share", date),
            "opens_year": F.coalesce(year != F.lag(year).over(W.orderBy(date)), F.lit(True)),
        }
    )
    month = F.struct(day, *columns)
    peak = F.min(
        F.when(F.col("gap").isNotNull(), F.struct((-F.col("gap")).alias("order"), day.alias("day")))
    )
    trough = F.min(
        F.when(
            F.col("smooth").isNotNull(), F.struct(F.col("smooth").alias("level"), day.alias("day"))
        )
    )
    start = F.make_date(F.lit(from_year), F.lit(1), F.lit(1))
    elapsed = F.datediff(day, start) / 365.25
    recent_gap = F.when(year >= from_year, F.col("gap"))
    opening = F.collect_list(F.when(F.col("opens_year"), F.struct(year, month)))
    return marked.agg(
        F.min(month).alias("first"),
        F.max(month).alias("last"),
        F.map_from_entries(opening).alias("opening"),
        (-peak["order"]).alias("peak_gap"),
        peak["day"].alias("peak_date"),
        trough["level"].alias("trough_level"),
        trough["day"].alias("trough_date"),
        F.regr_slope(recent_gap, elapsed).alias("slope"),
    )


def month_at(year: Column, date: str = "date") -> Column:
    """A profile's month for a year: its first one, or the last month of all in the last year."""
    last = F.col("last")
    return F.when(year == F.year(last[date]), last).otherwise(F.element_at("opening", year))


def _first_year() -> Column:
    return F.year(F.col("first")["date"])


def _last_year() -> Column:
    return F.year(F.col("last")["date"])


def _changes(start: Column, end: Column) -> dict[str, Column]:
    """What each side and the gap moved between two months."""
    male = end["male_share"] - start["male_share"]
    female = end["female_share"] - start["female_share"]
    return {"male": male, "female": female, "gap": male - female}


def _period(start: Column, end: Column) -> Column:
    return F.concat(start.cast("string"), F.lit("–"), end.cast("string"))


def headline() -> Column:
    last = F.col("last")
    return F.struct(
        round_half_even(last["gap"], 1).alias("gap_now"),
        round_half_even(last["male_share"], 1).alias("male_share_now"),
        round_half_even(last["female_share"], 1).alias("female_share_now"),
        round_half_even(month_at(_first_year())["gap"], 1).alias("gap_start"),
        round_half_even(F.col("peak_gap"), 1).alias("gap_peak"),
        F.col("peak_date").alias("gap_peak_date"),
    )


def turning_point() -> Column:
    now = F.col("last")["female_share"]
    return F.struct(
        F.col("trough_date").alias("date"),
        round_half_even(F.col("trough_level"), 1).alias("female_share_at_trough"),
        round_half_even(now, 1).alias("female_share_now"),
        round_half_even(now - F.col("trough_level"), 1).alias("recovery_ppt"),
        (F.year("trough_date") - _first_year()).alias("years_of_decline_before"),
    )


def contribution(start: Column, end: Column) -> Column:
    """How much of the movement between two years each side made, by size whatever the direction."""
    moved = _changes(month_at(start), month_at(end))
    men, women = F.abs(moved["male"]), F.abs(moved["female"])
    both = men + women
    return F.struct(
        _period(start, end).alias("period"),
        *[round_half_even(moved[who], 1).alias(f"{who}_change_ppt") for who in ("gap", "male", "female")],
        round_half_even(percent_of(men, both), 0).cast("int").alias("from_men_pct"),
        round_half_even(percent_of(women, both), 0).cast("int").alias("from_women_pct"),
    )


def _era(pair: Column) -> Column:
    start, end = pair["start"], pair["end"]
    moved = _changes(start["month"], end["month"])
    opening = [F.make_date(mark["year"], F.lit(1), F.lit(1)) for mark in (start, end)]
    years = F.datediff(opening[1], opening[0]) / 365.25
    return F.struct(
        _period(start["year"], end["year"]).alias("era"),
        *[round_half_even(moved[who], 1).alias(f"{who}_change_ppt") for who in ("male", "female", "gap")],
        round_half_even(moved["gap"] / years * 10, 1).alias("gap_change_per_decade"),
    )


def eras(boundaries: list[Column]) -> Column:
    """Array of the changes between each two successive boundary years that are increasing."""
    steps = len(boundaries) - 1
    marks = F.array(*[F.struct(y.alias("year"), month_at(y).alias("month")) for y in boundaries])
    pairs = F.zip_with(
        F.slice(marks, 1, steps),
        F.slice(marks, 2, steps),
        lambda start, end: F.struct(start.alias("start"), end.alias("end")),
    )
    increasing = F.filter(pairs, lambda pair: pair["start"]["year"] < pair["end"]["year"])
    return F.transform(increasing, _era)


def era_boundaries(years: list[int]) -> list[Column]:
    """Fixed years that lie before the turn, then the turn itself and the last year.

    A fixed year at or after the turn is moved to the turn, which leaves an empty era that is
    dropped.
    """
    turn = F.year("trough_date")
    return [*[F.least(F.lit(y), turn) for y in years], turn, _last_year()]


def levels() -> Column:
    start, now = month_at(_first_year()), F.col("last")

    def growth(column: str) -> Column:
        ratio = now[column] / F.nullif(start[column], F.lit(0.0))
        return round_half_even((ratio - 1) * 100, 0).cast("int").alias(f"{column}_growth_pct")

    def women_share(month: Column) -> Column:
        women = month["female_ft"]
        return round_half_even(percent_of(women, women + month["male_ft"]), 1)

    return F.struct(
        round_half_even(start["female_ft"], 0).cast("int").alias("female_ft_start"),
        round_half_even(now["female_ft"], 0).cast("int").alias("female_ft_now"),
        *[growth(column) for column in ("female_ft", "male_ft", "female_pt")],
        women_share(start).alias("women_share_of_ft_jobs_start"),
        women_share(now).alias("women_share_of_ft_jobs_now"),
    )


def male_parttime() -> Column:
    """The part-time share of men in the first year and now."""
    shares = {"start_pct": month_at(_first_year()), "now_pct": F.col("last")}
    return F.struct(
        *[
            round_half_even(percent_of(month["male_pt"], month["male_tot"]), 1).alias(name)
            for name, month in shares.items()
        ]
    )


def pace(from_year: int = 2010) -> Column:
    """The least-squares trend of the gap, and how long it would take to close it at that pace."""
    slope = F.col("slope")
    years = F.when(slope < 0, round_half_even(F.col("last")["gap"] / F.abs(slope), 0).cast("int"))
    return F.struct(
        round_half_even(slope * 10, 1).alias(f"ppt_per_decade_since_{from_year}"),
        years.alias("years_to_parity_at_that_pace"),
        (_last_year() + years).alias("parity_year_at_that_pace"),
    )
