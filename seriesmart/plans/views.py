"""Staging and marts as SQL text, for views that last in the catalog.

Spark keeps no view of a frame beyond its session, so these say in SQL what `operators/staging.py` and
`plans/marts.py` say with frames; tests hold both against each other. Selections are the marts' own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from seriesmart.operators.staging import ACCOUNT_CODES, CODES, LF_CODES, STAGED
from seriesmart.plans.marts import FULLTIME_PARTTIME, INDUSTRY, NATIONAL, STATES, Marts
from seriesmart.schemas import ACCOUNT_DIMENSIONS, LABOUR_ACCOUNT, LABOUR_FORCE, LF_DIMENSIONS, MART_CONTRACT


def rounded(value: str, digits: int) -> str:
    """Half away from zero on the decimal value."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    return f"({part}) / nullif({whole}, 0D) * 100"


def growth(value: str, before: str) -> str:
    return rounded(percent(f"{value} - {before}", before), 2)


def difference(value: str, before: str) -> str:
    return rounded(f"{value} - {before}", 3)


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _where(selection: dict) -> str:
    tests = []
    for attribute, wanted in selection.items():
        values = wanted if isinstance(wanted, list) else [wanted]
        tests.append(f"s.{attribute} IN ({', '.join(map(_literal, values))})")
    return " AND ".join(tests)


def staging_sql(lf: str, account: str) -> str:
    """One row per series and period of the two raw tables, keyed, dated and typed."""

    def part(table: str, dataflow: str, dimensions: list[str], codes: dict[str, str]) -> str:
        key = " || '.' || ".join([f"'{dataflow}'", *dimensions])
        text = "rtrim(time_period)"
        day = (
            f"CAST({text} || CASE WHEN length({text}) = 4 THEN '-01-01' WHEN substring({text}, 5, 1) = '-' THEN '-01' "
            f"WHEN {text} IS NOT NULL THEN CAST(raise_error('not a period: ' || {text}) AS STRING) END AS DATE)"
        )
        columns = [f"{codes[c]} AS {c}" if c in codes else f"CAST(NULL AS STRING) AS {c}" for c in CODES]
        return (
            f"SELECT {key} AS series_id, {day} AS period_date, '{dataflow}' AS source_dataflow, source_extract, "
            f"{', '.join(columns)}, time_period AS source_period, obs_value, unit_measure, unit_mult "
            f"FROM {table} WHERE obs_value IS NOT NULL"
        )

    keys = ["source_dataflow", "series_id", "period_date"]
    rest = [c for c in STAGED if c not in keys and c != "source_extract"]
    both = [part(lf, LABOUR_FORCE, LF_DIMENSIONS, LF_CODES), part(account, LABOUR_ACCOUNT, ACCOUNT_DIMENSIONS, ACCOUNT_CODES)]
    return f"""
SELECT {', '.join(STAGED)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY source_extract, {', '.join(rest)}) AS copy
  FROM ({' UNION ALL '.join(both)}))
WHERE copy = 1"""


def _wide(fact: str, series: str, selection: dict, keys: list[str], measures: dict[str, str], required: str) -> str:
    """Facts of a selection, one column per measure, without rows that lack what is required."""
    named = [f"{k} AS date" if k == "f.date_key" else k for k in keys]
    columns = [f"max(CASE WHEN s.measure_code = '{code}' THEN f.obs_value END) AS {name}" for code, name in measures.items()]
    return f"""SELECT * FROM (
    SELECT {', '.join([*named, *columns])}
    FROM {fact} f JOIN {series} s ON f.series_id = s.series_id AND f.source_dataflow = s.source_dataflow
    WHERE {_where(selection)} GROUP BY {', '.join(keys)}) WHERE {required}"""


def _mart(name: str, steps: list[str], columns: dict[str, str]) -> str:
    """Steps as common table expressions, then the columns of the contract in its order."""
    chosen = [f"{columns[c]} AS {c}" if c in columns else c for c in MART_CONTRACT[name].fieldNames()]
    return f"WITH {', '.join(steps)} SELECT {', '.join(chosen)} FROM last"


#: Over rows that are one per entity and period by now, so that the fact is read once.
_LATEST = "CAST(date = max(date) OVER () AS INT)"


def mart_sql(fact: str, series: str) -> dict[str, str]:
    """The four marts over a fact with its dataflow and a series dimension."""
    rate, level = "unemployment_rate_pct", "employed_thousands"
    measures = {
        "M3": level, "M6": "unemployed_thousands", "M12": "participation_rate_pct", "M13": rate,
        "M16": "emp_to_pop_ratio_pct",
    }
    national = _wide(fact, series, NATIONAL, ["f.date_key"], measures, f"{level} IS NOT NULL AND {rate} IS NOT NULL")
    lags = f"lag({rate}) OVER w AS rate1, lag({rate}, 12) OVER w AS rate12"
    overview = _mart(
        "v_national_overview",
        [
            f"wide AS ({national})",
            f"last AS (SELECT *, {lags}, lag({level}) OVER w AS level1, lag({level}, 12) OVER w AS level12 "
            "FROM wide WINDOW w AS (ORDER BY date))",
        ],
        {
            **{name: rounded(name, 2 if name.endswith("_pct") else 1) for name in measures.values()},
            "unemployment_rate_mom_change_ppt": difference(rate, "rate1"),
            "unemployment_rate_yoy_change_ppt": difference(rate, "rate12"),
            "employed_mom_change_pct": growth(level, "level1"),
            "employed_yoy_change_pct": growth(level, "level12"),
            "is_latest_month": _LATEST,
        },
    )
    keys = ["f.date_key", "s.region_code", "s.region_name"]
    states = _wide(fact, series, STATES, keys, {"M3": level, "M13": rate}, f"{rate} IS NOT NULL")
    by_state = _mart(
        "v_unemployment_by_state",
        [
            f"wide AS ({states})",
            f"last AS (SELECT *, {lags}, lag({level}, 12) OVER w AS level12 "
            "FROM wide WINDOW w AS (PARTITION BY region_code ORDER BY date))",
        ],
        {
            level: rounded(level, 1),
            rate: rounded(rate, 2),
            "unemployment_rate_mom_change_ppt": difference(rate, "rate1"),
            "unemployment_rate_yoy_change_ppt": difference(rate, "rate12"),
            "employed_yoy_change_pct": growth(level, "level12"),
            "is_latest_month": _LATEST,
        },
    )
    full, part, whole = (f"employed_{kind}_thousands" for kind in ("fulltime", "parttime", "total"))
    keys = ["f.date_key", "s.sex_code", "s.sex_name"]
    kinds = _wide(fact, series, FULLTIME_PARTTIME, keys, {"M1": full, "M2": part, "M3": whole}, f"{whole} IS NOT NULL")
    shares = {"fulltime_share_pct": percent(full, whole), "parttime_share_pct": percent(part, whole)}
    by_kind = _mart(
        "v_fulltime_parttime",
        [
            f"wide AS ({kinds})",
            "shares AS (SELECT *, " + ", ".join(f"{rounded(v, 2)} AS {name}" for name, v in shares.items()) + " FROM wide)",
            f"last AS (SELECT *, lag(fulltime_share_pct, 12) OVER w AS share12, lag({whole}, 12) OVER w AS whole12 "
            "FROM shares WINDOW w AS (PARTITION BY sex_code ORDER BY date))",
        ],
        {
            "sex_label": "sex_name",
            **{name: rounded(name, 1) for name in (full, part, whole)},
            "fulltime_share_yoy_change_ppt": difference("fulltime_share_pct", "share12"),
            "employed_total_yoy_change_pct": growth(whole, "whole12"),
            "is_latest_month": _LATEST,
        },
    )
    keys = ["f.date_key", "s.industry_code", "s.industry_name", "s.is_focus_industry"]
    divisions = _wide(fact, series, INDUSTRY, keys, {INDUSTRY["measure_code"]: level}, "TRUE")
    change = "employed_yoy_change_pct"
    by_industry = _mart(
        "v_industry_breakdown",
        [
            f"wide AS ({divisions})",
            f"lagged AS (SELECT *, lag({level}) OVER (PARTITION BY industry_code ORDER BY date) AS level1, "
            f"rank() OVER (PARTITION BY date ORDER BY {level} DESC NULLS LAST) AS place FROM wide)",
            f"last AS (SELECT *, {growth(level, 'level1')} AS {change} FROM lagged)",
        ],
        {
            level: rounded(level, 1),
            "employed_yoy_change_thousands": rounded(difference(level, "level1"), 1),
            "rank_by_employment": "CAST(place AS BIGINT)",
            "growth_category": f"CASE WHEN {change} >= 2 THEN 'Growing' WHEN {change} <= -2 THEN 'Shrinking' ELSE 'Stable' END",
            "is_latest_year": _LATEST,
        },
    )
    return {
        "v_national_overview": overview,
        "v_unemployment_by_state": by_state,
        "v_fulltime_parttime": by_kind,
        "v_industry_breakdown": by_industry,
    }


def marts_by_sql(fact: DataFrame, series: DataFrame) -> Marts:
    """The marts of a star from their SQL: each is analysed once, where frames are at every step.

    For queries that combine all marts of a star that is not stored, whose plans are long.
    """
    spark, names = fact.sparkSession, [f"star_{uuid.uuid4().hex}" for _ in range(2)]
    for name, df in zip(names, (fact, series), strict=True):
        df.createOrReplaceTempView(name)
    marts = Marts.of_names({name: spark.sql(sql) for name, sql in mart_sql(*names).items()})
    for name in names:
        spark.catalog.dropTempView(name)
    return marts
