"""Operators against brute force on small frames."""

from __future__ import annotations

import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seriesmart.operators import quality as Q
from seriesmart.operators import reporting as R
from seriesmart.operators import semantic as S
from seriesmart.operators.staging import align_and_union, dedupe, stg_observations
from seriesmart.operators.star import calendar_columns, day_spine, decode, dim_date, month_spine
from seriesmart.schemas import RAW_ACCOUNT, RAW_LF

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def month(i: int) -> dt.date:
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def monthly(spark, values, entity="a"):
    rows = [(entity, month(i), v) for i, v in values]
    return spark.createDataFrame(rows, "entity string, date date, v double")


@SLOW
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3)), max_size=40))
def test_dedupe_keeps_the_least_row(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, x int").repartition(5)
    least = {}
    for k, o, x in rows:
        least[k] = min(least.get(k, (o, x)), (o, x))
    got = {r.k: (r.o, r.x) for r in dedupe(df, ["k"], ["o"]).collect()}
    assert got == least


def test_dedupe_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    plan = dedupe(df, ["k"], ["x"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_staging_fills_codes_that_do_not_apply(spark):
    lf = spark.createDataFrame(
        [
            ("b", "f", "M3", "3", "1599", "20", "AUS", "M", "2020-01", 1.0, "NUM", 3, None),
            ("a", "f", "M3", "3", "1599", "20", "AUS", "M", "2020-01", 2.0, "NUM", 3, None),
            ("a", "f", "M3", "3", "1599", "20", "AUS", "M", "2020-02", None, "NUM", 3, None),
        ],
        RAW_LF,
    )
    account = spark.createDataFrame(
        [("i", "f", "M9", "AUS", "B", "A", "2020", 5.0, "NUM", 3, None)], RAW_ACCOUNT
    )
    rows = {r.series_id: r for r in stg_observations(lf, account).collect()}
    assert set(rows) == {"LF.M3.3.1599.20.AUS.M", "ABS_LABOUR_ACCT.M9.AUS.B.A"}
    monthly_row, annual_row = rows["LF.M3.3.1599.20.AUS.M"], rows["ABS_LABOUR_ACCT.M9.AUS.B.A"]
    assert (monthly_row.source_extract, monthly_row.obs_value, monthly_row.industry_code) == ("a", 2.0, None)
    assert (annual_row.sex_code, annual_row.tsest_code, annual_row.region_code) == (None, None, "AUS")
    assert (monthly_row.period_date, annual_row.period_date) == (dt.date(2020, 1, 1), dt.date(2020, 1, 1))
    with pytest.raises(ValueError):
        align_and_union(None, None)


def test_month_spine_has_no_holes(spark):
    observed = spark.createDataFrame([(dt.date(1978, 2, 1),), (dt.date(2026, 6, 1),)], "period_date date")
    dates = dim_date(observed)
    assert dates.count() == 581
    first = dates.orderBy("date_key").first()
    assert (first.month_year, first.quarter, first.financial_year) == ("Feb 1978", "Q1", "FY1978")
    empty = month_spine(spark.createDataFrame([(None, None)], "first_period date, last_period date"))
    assert empty.count() == 0


def test_day_spine(spark):
    days = day_spine(spark, dt.date(1979, 3, 1))
    assert days.count() == (dt.date(1979, 3, 1) - dt.date(1978, 1, 1)).days + 1
    july = days.filter("date = date'1978-07-01'").first()
    assert (july.financial_year, july.financial_year_sort, july.is_first_of_month) == ("FY1979", 1979, 1)


def test_month_names_do_not_follow_the_locale(spark):
    months = spark.createDataFrame([(month(i),) for i in range(12)], "d date")
    names = [r.month_name for r in calendar_columns(months, "d").orderBy("d").collect()]
    assert names == "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def test_decode_fallbacks(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "code string")
    codes = spark.createDataFrame([("1", "one", 1)], "code string, name string, flag int")
    rows = decode(df, codes, "code", {"name": F.col("code"), "flag": F.lit(0)}).collect()
    assert {(r.code, r["name"], r.flag) for r in rows} == {("1", "one", 1), ("9", "9", 0), (None, None, 0)}


def test_positional_and_calendar_lag_agree_without_gaps_and_differ_with(spark):
    full = [(i, float(i * i)) for i in range(30)]
    df = R.calendar_lag(
        R.with_lags(monthly(spark, full), ["entity"], "date", {"v": [12]}), ["entity"], "date", "v", 12
    )
    assert df.filter("not (v_lag12 <=> v_m12)").count() == 0
    holed = [p for p in full if p[0] != 5]
    df = R.calendar_lag(
        R.with_lags(monthly(spark, holed), ["entity"], "date", {"v": [12]}), ["entity"], "date", "v", 12
    )
    values, places = dict(holed), {i: n for n, (i, _) in enumerate(holed)}
    by_place = [v for _, v in holed]
    for r in df.collect():
        i = (r.date.year - 2000) * 12 + r.date.month - 1
        assert r.v_m12 == values.get(i - 12)
        assert r.v_lag12 == (by_place[places[i] - 12] if places[i] >= 12 else None)


def test_rank_leaves_gaps_after_ties(spark):
    rows = [(1, "a", 5.0), (1, "b", 5.0), (1, "c", 4.0), (1, "d", None), (2, "a", 1.0)]
    df = spark.createDataFrame(rows, "date int, x string, v double")
    got = {(r.date, r.x): r.r for r in df.withColumn("r", R.rank_within("date", "v")).collect()}
    assert got == {(1, "a"): 1, (1, "b"): 1, (1, "c"): 3, (1, "d"): 4, (2, "a"): 1}


def test_select_facts_prunes_by_dataflow(spark, scratch):
    """Whatever series ids look like, a fact partitioned by dataflow is read for the selected one only."""
    series = spark.createDataFrame(
        [("LF.M1.x", "LF", "M1"), ("7", "LF", "M1"), ("LF.M13.x", "LF", "M13"), ("OTHER.M1.x", "OTHER", "M1")],
        "series_id string, source_dataflow string, measure_code string",
    )
    rows = [(s.series_id, s.source_dataflow, i, float(i)) for s in series.collect() for i in range(4)]
    path = f"{scratch}/fact"
    facts = spark.createDataFrame(rows, "series_id string, source_dataflow string, date_key int, obs_value double")
    facts.write.partitionBy("source_dataflow").parquet(path)
    picked = R.select_facts(
        spark.read.parquet(path), series, {"source_dataflow": "LF", "measure_code": ["M1"]}
    ).select("series_id", "obs_value")
    assert {r.series_id for r in picked.collect()} == {"LF.M1.x", "7"} and picked.count() == 8
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*source_dataflow#\d+ = LF", plan)
    assert "ReadSchema: struct<series_id:string,obs_value:double>" in plan


def test_keep_and_exclude(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r.x for r in S.keep(df, "x", ["a"]).collect()] == ["a"]
    assert {r.x for r in S.keep(df, "x", ["a"], exclude=True).collect()} == {"b", None}


def test_latest_value_with_and_without_filter(spark):
    rows = [(month(1), "P", 5.0), (month(2), "P", None), (month(2), "Q", 9.0), (month(0), "P", 7.0)]
    df = spark.createDataFrame(rows, "date date, who string, v double")
    assert S.latest_value(df, ["v"]).first().v == 9.0
    assert S.latest_value(df, ["v"], F.col("who") == "P").first().v is None
    assert S.latest_value(S.slice_dates(df, None, month(1)), ["v"]).first().v == 5.0


def test_chart_query_averages_and_sums_by_name(spark):
    rows = [("a", 1.0, 10.0), ("a", 2.0, 20.0), ("b", 9.0, 1.0), ("c", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, rate_pct double, jobs_thousands double")
    got = S.chart_query(df, "k", ["jobs_thousands", "rate_pct"], filters=[("k", ["c"], True)], sort="desc")
    assert [tuple(r) for r in got.collect()] == [("a", 30.0, 1.5), ("b", 1.0, 9.0)]


def test_page_rows_equal_single_chart_queries(spark):
    rng = random.Random(3)
    rows = [(month(i), e, rng.randint(0, 9) / 4, float(i)) for i in range(20) for e in "ab"]
    df = spark.createDataFrame(rows, "date date, e string, rate_pct double, jobs_thousands double")
    page = S.page_rows(
        df,
        [S.Chart("by e", "e", ("rate_pct", "jobs_thousands"), where=F.col("date") > month(9), ranked=True)],
        [S.Card("last", "rate_pct", F.col("e") == "b")],
    )
    got = {(r.visual, r.category, r.measure): r.value for r in page.collect()}
    single = S.auto_agg(df.filter(F.col("date") > month(9)), ["e"], ["rate_pct", "jobs_thousands"])
    expected = {("by e", r.e, m): r[m] for r in single.collect() for m in ("rate_pct", "jobs_thousands")}
    expected["last", None, "rate_pct"] = [r[2] for r in rows if r[1] == "b"][-1]
    assert got == expected
    positions = [(r.position, r.value) for r in page.collect() if r.visual == "by e"]
    assert [v for _, v in sorted(positions)] == sorted((v for _, v in positions), reverse=True)
    assert [r.position for r in page.collect() if r.visual == "last"] == [None]


def test_percent_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 9.0)], "k string, v double")
    got = {r.k: r.percent_of_total for r in S.percent_of_total(df, "k", "v").collect()}
    assert got == {"a": 25.0, "b": 75.0}


def test_trailing_years_and_latest_row(spark):
    df = monthly(spark, [(i, float(i)) for i in range(40)])
    recent = S.trailing_years(df, 2)
    assert recent.agg(F.min("date")).first()[0] == month(15)
    assert S.latest_row(df).first().v == 39.0


def test_type_by_name(spark):
    text = spark.createDataFrame(
        [("2020-01-01", "1", "2", "1.5", "x")],
        "date string, is_latest string, rank_by string, a_pct string, label string",
    )
    assert [t for _, t in S.type_by_name(text).dtypes] == ["date", "bigint", "bigint", "double", "string"]


def test_crosstab_is_descending(spark):
    rows = [(2020, "a", 1.0), (2020, "a", 2.0), (2021, "b", 4.0)]
    df = spark.createDataFrame(rows, "year int, m string, v double")
    got = [tuple(r) for r in S.crosstab(df, "year", "m", ["a", "b"], "v").collect()]
    assert got == [(2021, None, 4.0), (2020, 1.5, None)]


# --- Quality -------------------------------------------------------------------------------------


@SLOW
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]), st.integers(0, 2)), max_size=30))
def test_checks_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    n = defaultdict(int)
    for k, _ in rows:
        n[k] += 1
    assert Q.failing_not_null(df, "k").count() == n[None]
    unique = {r.k: r.n_rows for r in Q.failing_unique(df, "k").collect()}
    assert unique == {k: c for k, c in n.items() if k and c > 1}
    accepted = {r.k: r.n_rows for r in Q.failing_accepted(df, "k", ["a"]).collect()}
    assert accepted == {k: c for k, c in n.items() if k in ("b", "c")}
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "p string")
    missing = {r.k: r.n_rows for r in Q.failing_fk(df, "k", parent, "p").collect()}
    assert missing == {k: c for k, c in n.items() if k == "c"}
    combos = defaultdict(list)
    for k, v in rows:
        combos[k].append(v)
    overlap = {r.k: (r.copies, r.spread) for r in Q.failing_overlap(df, ["k"], "v").collect()}
    assert overlap == {k: (len(v), max(v) - min(v)) for k, v in combos.items() if max(v) > min(v)}
    coverage = {r.k: r.members for r in Q.failing_coverage(df, "k", "v", 2).collect()}
    assert coverage == {k: len(set(v)) for k, v in combos.items() if len(set(v)) != 2}


def test_accepted_values_with_condition(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 1)], "k string, v int")
    assert Q.failing_accepted(df, "k", ["z"], F.col("v") == 1).collect()[0].k == "x"


def test_mixed_basis_as_declared_cannot_fail_but_feeding_can(spark):
    series = spark.createDataFrame(
        [("s1", "20", "Seasonally adjusted"), ("s2", "30", "Trend")],
        "series_id string, tsest_code string, adjustment_type string",
    )
    fact = spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "series_id string, obs_value double")
    where = {"tsest_code": "30"}
    assert Q.failing_mixed_basis(Q.comparison_series(series, where)).count() == 0
    (row,) = Q.failing_mixed_basis(Q.feeding_series(fact, series, where)).collect()
    assert tuple(row) == (2, "Seasonally adjusted", "Trend")


def test_contract_verdicts(spark):
    declared = {"t": ["a", "b"]}

    def status(actual):
        return tuple(Q.check_contract(spark, declared, {"t": actual}).first())[1:]

    assert status(["a", "b"]) == ("ok", [], [])
    assert status(["b", "a"]) == ("order differs", [], [])
    assert status(["a", "c"]) == ("mismatch", ["b"], ["c"])
    assert status(None) == ("missing view", ["a", "b"], [])


def test_diff_classifies_every_key(spark):
    left = spark.createDataFrame(
        [(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (4, "w", 1.0), (5, "d", 1.0), (5, "d", 2.0)],
        "k int, a string, b double",
    )
    right = spark.createDataFrame(
        [(1, "x", 1.0), (2, "y", 2.0), (3, "Z", 4.0), (6, "n", 1.0), (5, "d", 1.0)], "k int, a string, b double"
    )
    rows = {r.k: (r.status, r.changed) for r in Q.diff_rows(left, right, ["k"]).collect()}
    assert rows == {
        2: ("changed", ["b"]), 3: ("changed", ["a", "b"]), 4: ("only left", None),
        5: ("repeated key", None), 6: ("only right", None),
    }
    summary = {(r.status, r.column): r.n_keys for r in Q.diff_tables(left, right, ["k"]).collect()}
    assert summary["changed", "b"] == 2 and summary["changed", "a"] == 1


def test_run_checks_and_enforce(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "q")], "id int, k string")
    parent = spark.createDataFrame([("a",)], "k string")
    checks = Q.Checks(
        not_null=["id", "k"], unique=["id"], accepted={"k": ["a", "b"]}, grain=["id", "k"],
        references={"k": ("parent", "k")},
    )
    results = Q.run_checks(df, checks, {"parent": parent})
    found = {(r.check, r.column): r.failures for r in results.collect()}
    assert found == {
        ("not_null", "id"): 0, ("not_null", "k"): 1, ("accepted_values", "k"): 1, ("unique", "id"): 1,
        ("grain", "id, k"): 0, ("relationships", "k"): 1,
    }
    assert len(checks) == 6
    with pytest.raises(Q.CheckFailure, match="not_null on k: 1"):
        Q.enforce("t", results)
    warn = Q.run_checks(df, Q.Checks(not_null=["k"], severity="warn"))
    assert [r.failures for r in Q.enforce("t", warn)] == [1]


def test_widen_rejects_two_rows_for_one_cell(spark):
    from seriesmart.operators.analysis import widen

    df = spark.createDataFrame([(month(0), "Male", 1.0), (month(0), "Male", 2.0)], "date date, m string, v double")
    with pytest.raises(PySparkException, match="more than one row for Male"):
        widen(df, "date", "m", ["Male", "Female"], {"v": "v"}).collect()


def test_builds_that_differ_in_columns_are_not_equal(spark):
    left = spark.createDataFrame([(1, 2, "x")], "k int, a int, gone string")
    right = spark.createDataFrame([(1, 2, 3), (2, 2, 3)], "k int, added int, a int")
    found = {(r.status, r.column, r.n_keys) for r in Q.diff_builds(left, right, ["k"]).collect()}
    assert found == {
        ("changed", "a", 1), ("only right", None, 1), ("column only left", "gone", None), ("column only right", "added", None),
        ("rows differ", None, 1),
    }


def test_one_check_may_warn_while_others_stop(spark, caplog):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    lenient = Q.Checks(not_null=["k", "v"], warn=[("not_null", "k")])
    found = {r.column: (r.failures, r.severity) for r in Q.run_checks(df, lenient).collect()}
    assert found == {"k": (1, "warn"), "v": (0, "error")}
    Q.enforce("t", Q.run_checks(df, lenient))
    assert "not_null on k: 1" in caplog.text
    with pytest.raises(Q.CheckFailure, match="not_null on k: 1"):
        Q.enforce("t", Q.run_checks(df, Q.Checks(not_null=["k"])))


def test_contract_covers_types_and_positions(spark):
    from pyspark.sql import types as T

    declared = T._parse_datatype_string("date date, rate double, flag int")
    actual = T._parse_datatype_string("date date, rate string, other int")
    found = [tuple(r) for r in Q.check_fields(spark, {"v": declared}, {"v": actual}).collect()]
    assert found == [("v", 1, "type", "rate double", "rate string"), ("v", 2, "name", "flag int", "other int")]
