"""The expected grid, checks in one pass, diffs by digest, totals and the calendar slicer."""

from __future__ import annotations

import datetime as dt
import itertools
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_plans import scans_that_ran

from seriesmart.catalog import QUERIES
from seriesmart.functions.numbers import exact_avg
from seriesmart.operators import quality as Q
from seriesmart.operators import semantic as S
from seriesmart.operators.star import day_spine
from seriesmart.schemas import EXTRACTS
from seriesmart.sources import observations as O
from seriesmart.sources.codelists import load_seed

JAN, FEB, MAR, APR = (dt.date(2020, m, 1) for m in range(1, 5))


# --- Coverage grid -------------------------------------------------------------------------------


def test_grid_finds_whole_periods_and_members(spark):
    rows = [(JAN, "a"), (JAN, "b"), (JAN, "b"), (FEB, "a"), (APR, "a"), (APR, "b"), (None, "a"), (APR, None), (APR, "z")]
    df = spark.createDataFrame(rows, "p date, m string")
    codes = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "code string")
    found = {tuple(r) for r in Q.missing_members(df, "p", "m", codes, "code").collect()}
    never = {(day, "c") for day in (JAN, FEB, MAR, APR)}
    assert found == never | {(FEB, "b"), (MAR, "a"), (MAR, "b")}


def test_grid_of_nothing(spark):
    df = spark.createDataFrame([], "p date, m string")
    codes = spark.createDataFrame([("a",)], "code string")
    assert Q.missing_members(df, "p", "m", codes, "code").count() == 0
    full = spark.createDataFrame([(JAN, "a")], "p date, m string")
    assert Q.missing_members(full, "p", "m", codes, "code").count() == 0
    assert Q.missing_members(full, "p", "m", codes.limit(0), "code").count() == 0


def test_grid_joins_no_two_sides_whole(spark):
    plan = QUERIES["dq_coverage_grid"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- Checks in one pass --------------------------------------------------------------------------


def separately(df, checks, parents):
    """Each check on its own, as the single functions have it."""
    found = {("not_null", c): Q.failing_not_null(df, c).count() for c in checks.not_null}
    found |= {("accepted_values", c): df.filter(Q.outside(c, v)).count() for c, v in checks.accepted.items()}
    found |= {("unique", c): Q.failing_unique(df, c).count() for c in checks.unique}
    if checks.grain:
        found["grain", ", ".join(checks.grain)] = Q.failing_grain(df, checks.grain).count()
    for c, (parent, column) in checks.references.items():
        found["relationships", c] = Q.failing_fk(df, c, parents[parent], column).count()
    return found


def test_one_pass_is_the_checks_one_by_one(spark):
    values = [None, "", "a", "b", "1:a", "-", "a|b"]
    rows = [(x, y, n, float(n or 0)) for (x, y), n in zip(itertools.product(values, values), itertools.cycle([1, 2, None, 3, 7]))]
    df = spark.createDataFrame(rows + rows[:9], "x string, y string, n int, v double")
    parents = {
        "p": spark.createDataFrame([("a",), ("a",), (None,), ("",)], "code string"),
        "q": spark.createDataFrame([(1,), (7,)], "id bigint"),
    }
    checks = Q.Checks(
        not_null=["x", "n"], unique=["x", "n", "v"], accepted={"y": ["a", "b"], "n": [1, 2]}, grain=["x", "y"],
        references={"x": ("p", "code"), "n": ("q", "id")}, warn=[("unique", "n")],
    )
    got = Q.run_checks(df, checks, parents).collect()
    assert {(r.check, r.column): r.failures for r in got} == separately(df, checks, parents)
    assert len(got) == len(checks) and {r.column for r in got if r.severity == "warn"} == {"n"}
    empty = Q.run_checks(df.limit(0), checks, parents).collect()
    assert len(empty) == len(checks) and not any(r.failures for r in empty)
    assert Q.run_checks(df, Q.Checks()).collect() == []


def test_keys_that_only_look_alike_differ(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("", None), (None, "")], "x string, y string")
    (row,) = Q.run_checks(df, Q.Checks(grain=["x", "y"])).collect()
    assert row.failures == 0


def test_all_checks_of_a_stored_table_read_it_once(spark, scratch):
    QUERIES["stg_labour_force"](spark, SF_SMALL).write.parquet(f"{scratch}/staged")
    staged = spark.read.parquet(f"{scratch}/staged")
    seeds = {name: load_seed(spark, name) for name in ("seed_measure", "seed_region")}
    from seriesmart.plans.checks import CHECKS

    checks = CHECKS["stg_labour_force"]
    results = Q.run_checks(staged, checks, seeds)
    assert len(scans_that_ran(results)) == 1
    plan = results._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(set(re.findall(r"Exchange hashpartitioning\(place#\d+, key#\d+", plan))) == 1
    assert {(r.check, r.column): r.failures for r in results.collect()} == separately(staged, checks, seeds)


# --- Diff by digests -----------------------------------------------------------------------------

BUILD = "k int, l string, v double, w string"


def build_rows(n=500):
    return [(k, None if k % 7 == 0 else f"l{k}", k / 3, None if k % 5 == 0 else "w") for k in range(n)]


def changed(rows):
    rows = list(rows)
    rows[10] = (10, "l10", 99.0, None)
    rows[33] = (33, "l33", 11.0, None)  # a value became null
    del rows[70]
    return [*rows, (1000, "new", 1.0, "w")]


@pytest.mark.parametrize("by", [None, "floor(k / 50)"])
def test_diff_by_digest_is_the_diff(spark, by):
    ranges = F.expr(by) if by else None
    left = spark.createDataFrame(build_rows(), BUILD)
    right = spark.createDataFrame(changed(build_rows()), BUILD)
    plain = sorted(map(repr, Q.diff_rows(left, right, ["k", "l"]).collect()))
    assert sorted(map(repr, Q.diff_rows_by_digest(left, right, ["k", "l"], ranges).collect())) == plain
    assert len(plain) == 4
    whole = sorted(map(repr, Q.diff_builds(left, right, ["k", "l"]).collect()))
    assert sorted(map(repr, Q.diff_builds(left, right, ["k", "l"], True, ranges).collect())) == whole
    assert 0 < Q.differing_ranges(left, right, ["k", "l"], ranges).count() <= 4


def test_digests_tell_nulls_apart_and_count_copies(spark):
    def ranges(a, b):
        return Q.differing_ranges(spark.createDataFrame(a, BUILD), spark.createDataFrame(b, BUILD), ["k"]).count()

    assert ranges([(1, None, 1.0, "x")], [(1, "x", 1.0, None)]) == 1
    assert ranges([(1, "x", 1.0, "y")], [(1, "x", 1.0, "y")] * 3) == 1
    assert ranges(build_rows(50), build_rows(50)[::-1]) == 0
    assert ranges([], []) == 0


def test_equal_builds_move_digests_only(spark, scratch):
    spark.createDataFrame(build_rows(), BUILD).write.parquet(f"{scratch}/build")
    left, right = spark.read.parquet(f"{scratch}/build"), spark.read.parquet(f"{scratch}/build")
    found = Q.diff_rows_by_digest(left, right, ["k", "l"])
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Final Plan ==\s+ResultQueryStage \d+\s+\+- EmptyRelation", plan)


def test_diff_takes_builds_with_other_types(spark):
    left = spark.createDataFrame([(1, 2.0)], "k int, v double")
    right = spark.createDataFrame([(1, 2)], "k bigint, v int")
    assert Q.diff_rows_by_digest(left, right, ["k"]).collect() == []


# --- Totals --------------------------------------------------------------------------------------


def test_totals_are_measured_anew(spark):
    rows = [(JAN, "a", 1.0), (FEB, "a", 2.0), (JAN, "b", 9.0), (JAN, None, 4.0)]
    df = spark.createDataFrame(rows, "date date, m string, v double")
    measures = {"mean": exact_avg(F.col("v")), "last": S.at_latest("v")}
    got = {(r.m, r.date, r.level): (r.mean, r.last) for r in S.with_totals(df, ["m", "date"], measures).collect()}
    assert got[None, None, 3] == (4.0, 2.0)  # neither the mean of means nor the sum of the last values
    assert got["a", None, 1] == (1.5, 2.0) and got["b", None, 1] == (9.0, 9.0)
    assert got[None, None, 1] == (4.0, 4.0)  # the null member is not the total
    assert got[None, JAN, 2][0] == pytest.approx(14 / 3, abs=1e-6) and len(got) == 4 + 3 + 2 + 1


def test_crosstab_with_totals(spark):
    rows = [(2020, "x", 1.0), (2020, "y", 3.0), (2020, "y", 5.0), (2021, "x", 8.0), (2021, "other", 99.0)]
    df = spark.createDataFrame(rows, "year int, m string, v double")
    got = [tuple(r) for r in S.crosstab_with_totals(df, "year", "m", ["x", "y"], exact_avg(F.col("v"))).collect()]
    assert got == [(2021, 0, 8.0, None, 8.0), (2020, 0, 1.0, 4.0, 3.0), (None, 1, 4.5, 4.0, 4.25)]


# --- Calendar slicer -----------------------------------------------------------------------------


def test_a_slicer_leaves_lags_alone(spark):
    marts = {
        "m": spark.createDataFrame([(JAN, 1.0, None), (FEB, 2.0, 1.0), (MAR, 4.0, 2.0)], "date date, v double, v_lag1 double"),
        "n": spark.createDataFrame([(FEB, "a"), (FEB, "b"), (None, "c")], "date date, k string"),
    }
    calendar = day_spine(spark, dt.date(2020, 12, 31))
    sliced = S.slice_calendar(marts, calendar, {"month_number": [2, 3], "year": [2020]})
    assert [tuple(r) for r in sliced["m"].orderBy("date").collect()] == [(FEB, 2.0, 1.0), (MAR, 4.0, 2.0)]
    assert sorted(r.k for r in sliced["n"].collect()) == ["a", "b"]
    assert S.slice_calendar(marts, calendar, {"quarter": []})["m"].count() == 0


def test_the_calendar_is_read_lazily(spark):
    end = spark.createDataFrame([(dt.date(1978, 1, 3),), (None,), (dt.date(1978, 1, 2),)], "date date")
    assert day_spine(spark, end).count() == 3
    assert day_spine(spark, end.limit(0)).count() == 1
    assert day_spine(spark, dt.date(1978, 1, 5)).count() == 5


# --- Members in the failure ----------------------------------------------------------------------


def test_an_incomplete_extract_names_its_members(spark):
    state = next(e for e in EXTRACTS if e.name == "state_summary")
    columns = {**{c: "x" for c in ("dataflow", "age", "tsest", "freq")}, "sex": "3", "time_period": "2020-01"}
    rows = [("state_summary", m, r) for m in ("M3", "M13") for r in ("1", "2", "4", "5", "6", "8")]
    df = spark.createDataFrame(rows, "source_extract string, measure string, region string")
    df = df.withColumns({c: F.lit(v) for c, v in columns.items()})
    states = load_seed(spark, "seed_region").filter("geography_level <> 'National'")
    (row,) = O.ingest_report(df, [state], {"region": states}).collect()
    assert row.detail == "expected 8 distinct region, got 6: 1, 2, 4, 5, 6, 8; missing 3, 7"
    (row,) = O.ingest_report(df, [state]).collect()
    assert row.detail == "expected 8 distinct region, got 6: 1, 2, 4, 5, 6, 8"
    with pytest.raises(RuntimeError, match="missing 3, 7"):
        O.raise_on_problems(O.ingest_report(df, [state], {"region": states}))
    many = spark.range(100).select(
        F.lit("state_summary").alias("source_extract"), F.format_string("r%03d", "id").alias("region"),
        F.lit("M3").alias("measure"), F.lit("3").alias("sex"),
    )
    (row,) = O.ingest_report(many, [state], {"region": states}).collect()
    assert row.status == "incomplete" and ", r039, ..." in row.detail and "r040" not in row.detail
    assert "expected 8 distinct region, got 100" in row.detail
