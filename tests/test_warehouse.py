"""The whole build on invented files, and what must stop it."""

from __future__ import annotations

import copy
import json
from decimal import ROUND_HALF_UP, Decimal
from pathlib import Path

import fixture_files as files
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seriesmart import sinks
from seriesmart.operators import quality as Q
from seriesmart.operators.semantic import type_by_name
from seriesmart.plans import gap_report, kpis
from seriesmart.plans.checks import CHECKS
from seriesmart.plans.warehouse import Config, build, declared_checks
from seriesmart.schemas import MART_CONTRACT


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = files.write(str(tmp_path_factory.mktemp("raw")))
    return build(spark, Config(raw, export_dir=str(tmp_path_factory.mktemp("export"))))


def half_up(values, digits: int) -> list[float]:
    step = Decimal(1).scaleb(-digits)
    return [float(Decimal(repr(float(v))).quantize(step, ROUND_HALF_UP)) for v in values]


def broken(spark, directory, change, match, error=Q.CheckFailure, **options):
    contents = copy.deepcopy(files.contents())
    change(contents)
    files.write(directory, contents)
    with pytest.raises(error, match=match):
        build(spark, Config(directory, **options))


def test_declared_checks_are_complete():
    count = lambda part: sum(len(getattr(c, part)) for c in CHECKS.values())
    assert count("not_null") == 73 and count("accepted") == 27 and count("unique") == 11
    assert count("references") == 5 and sum(bool(c.grain) for c in CHECKS.values()) == 5
    assert declared_checks() == 121


def test_row_counts(built):
    months = len(files.MONTHS)
    assert built.raw["LF"].count() == months * 32
    # The overlapping series is kept once and the one gap is dropped.
    expected = months * 31 - 1 + len(files.INDUSTRIES) * 3
    assert built.staged.count() == built.fact.count() == expected
    assert built.series.count() == 31 + len(files.INDUSTRIES)
    assert built.dates.count() == 36  # 2019-01 to 2021-12


def test_every_check_ran_and_passed(built):
    assert set(CHECKS) <= set(built.checks)
    ran = sum(len(built.checks[name]) for name in CHECKS)
    assert ran == 121
    assert all(r.failures == 0 for rows in built.checks.values() for r in rows)


def test_marts_follow_their_contract(built):
    for name, mart in built.marts.by_name().items():
        contract = MART_CONTRACT[name]
        assert mart.columns == contract.fieldNames()
        assert [f.dataType for f in mart.schema] == [f.dataType for f in contract]


def test_national_mart_against_pandas(built):
    got = built.marts.national.orderBy("date").toPandas()
    level = pd.Series([files.level("M3", "3", "AUS", i) for i in range(len(files.MONTHS))])
    rate = pd.Series([files.level("M13", "3", "AUS", i) for i in range(len(files.MONTHS))])
    assert got.employed_thousands.tolist() == half_up(level, 1)
    yoy = (level - level.shift(12)) / level.shift(12) * 100
    assert got.employed_yoy_change_pct[12:].tolist() == half_up(yoy[12:], 2)
    assert got.employed_yoy_change_pct[:12].isna().all()
    change = rate - rate.shift(1)
    assert got.unemployment_rate_mom_change_ppt[1:].tolist() == half_up(change[1:], 3)
    assert got.is_latest_month.tolist() == [0] * 23 + [1]
    assert got.participation_rate_pct.isna().sum() == 1


def test_state_mart_covers_every_region_every_month(built):
    per_month = built.marts.state.groupBy("date").agg(F.count_distinct("region_code").alias("n"))
    assert per_month.filter("n <> 8").count() == 0
    assert built.marts.state.filter("is_latest_month = 1").count() == 8


def test_persons_is_the_total_of_the_sexes(built):
    by_sex = built.marts.ftpt.groupBy("date").pivot("sex_label").agg(F.first("employed_total_thousands"))
    assert by_sex.filter("abs(Persons - Male - Female) > 0.11").count() == 0


def test_industry_mart_has_divisions_only(built):
    got = built.marts.industry.toPandas()
    assert sorted(set(got.industry_code)) == list("ABCDEFGHIJKLMNOPQRS")
    assert set(got[got.is_focus_industry == 1].industry_code) == set("EGJQ")
    latest = got[got.is_latest_year == 1].set_index("industry_code")
    ranks = latest.employed_thousands.rank(ascending=False, method="min").astype(int)
    assert latest.rank_by_employment.to_dict() == ranks.to_dict()
    first = got[got.date == got.date.min()]
    assert set(first.growth_category) == {"Stable"} and first.employed_yoy_change_pct.isna().all()


def test_gaps_in_a_series_leave_unknown_sub_divisions_in_the_dimension(built):
    (row,) = built.series.filter("industry_code = 'B06'").collect()
    assert (row.industry_name, row.is_industry_division, row.sex_name) == ("B06", 0, "Not applicable")


def test_views_are_registered(spark, built):
    for name in ("mart.v_national_overview", "v_national_overview"):
        assert spark.sql(f"SELECT 1 FROM {name} WHERE is_latest_month = 1").count() == 1
    assert spark.table("staging.stg_labour_force").count() == built.staged.count()
    joined = spark.sql(
        "SELECT d.financial_year, count(*) AS n FROM core.fct_labour_force f "
        "JOIN core.dim_date d USING (date_key) JOIN core.dim_series s USING (series_id) GROUP BY 1"
    )
    assert joined.count() == 4


def test_exports_round_trip(spark, built):
    for name, path in zip(MART_CONTRACT, built.exports):
        mart = built.marts.by_name()[name]
        again = type_by_name(sinks.read_export(spark, path))
        assert again.columns == mart.columns
        keys = [c for c in ("date", "region_code", "sex_code", "industry_code") if c in mart.columns]
        same = mart.select(*[F.col(c).cast(t).alias(c) for c, t in again.dtypes])
        assert Q.diff_rows(same, again, keys).count() == 0
    directory = built.exports[0].rsplit("/", 1)[0]
    assert set(sinks.check_exports(spark, directory).values()) == {"ok"}


def test_export_order_and_byte_order_mark(spark, built):
    path = next(p for p in built.exports if p.endswith("unemployment_by_state"))
    (part,) = Path(path).glob("part-*.csv")
    lines = part.read_text(encoding="utf-8").splitlines()
    assert lines[0].startswith("\ufeffdate,region_code")
    keys = [(line.split(",")[2], line.split(",")[0]) for line in lines[1:]]
    assert keys == sorted(keys)


def test_stale_and_missing_exports(spark, built, scratch):
    built.marts.national.drop("is_latest_month").coalesce(1).write.option("header", True).csv(f"{scratch}/national_overview")
    verdicts = sinks.check_exports(spark, scratch)
    assert verdicts["national_overview"] == "stale" and verdicts["fulltime_parttime"] == "skipped"


def test_kpis_over_built_marts(built):
    marts = {"national": built.marts.national, "state": built.marts.state, "ftpt": built.marts.ftpt, "industry": built.marts.industry}
    values = kpis.kpi_values(marts)
    shown = {r.measure: r.text for r in kpis.kpi_texts(values).collect()}
    assert len(shown) == 19
    last = files.level("M3", "3", "AUS", 23)
    assert shown["Latest Employed Thousands"] == f"{last:,.1f}"
    assert shown["Employed Subtitle"].endswith("% vs last year")


def test_figures_document_is_written(built, scratch, spark):
    document = gap_report.figures_json(gap_report.figures(built.marts.ftpt, [2020], 2020, 2020))
    sinks.write_figures(document, f"{scratch}/figures")
    (line,) = spark.read.text(f"{scratch}/figures").collect()
    assert json.loads(line.value)["period"] == {"from": "2020-01-01", "to": "2021-12-01"}


def test_views_instead_of_tables_give_the_same(spark, built, scratch):
    fact = sorted(map(tuple, built.fact.collect()))
    marts = {n: sorted(map(repr, df.collect())) for n, df in built.marts.by_name().items()}
    again = build(spark, Config(files.write(scratch), write_all=False))
    assert sorted(map(tuple, again.fact.collect())) == fact
    assert {n: sorted(map(repr, df.collect())) for n, df in again.marts.by_name().items()} == marts


def test_missing_region_stops_the_build(spark, scratch):
    def change(contents):
        header, rows = contents["state_summary"]
        contents["state_summary"] = (header, [r for r in rows if r[5] != "7"])

    broken(spark, scratch, change, "state_summary: incomplete", RuntimeError)


def test_a_region_missing_in_one_month_stops_the_build(spark, scratch):
    def change(contents):
        header, rows = contents["state_summary"]
        contents["state_summary"] = (header, [r for r in rows if (r[5], r[7]) != ("7", "2020-03")])

    broken(spark, scratch, change, "all_members_present")


def test_disagreeing_copies_stop_the_build(spark, scratch):
    def change(contents):
        rows = contents["national_summary"][1]
        rows[0][8] = repr(float(rows[0][8]) + 0.001)

    broken(spark, scratch, change, "overlapping_extracts_agree")


def test_unknown_measure_stops_the_build(spark, scratch):
    def change(contents):
        contents["national_trend"][1][0][1] = "M77"

    broken(spark, scratch, change, "stg_labour_force: .*relationships on measure_code: 1")


def test_null_code_fails_the_load(spark, scratch):
    def change(contents):
        contents["national_trend"][1][0][2] = ""

    broken(spark, scratch, change, "null in required column sex", PySparkException)


def test_a_failing_overwrite_leaves_the_old_table(spark):
    sinks.ensure_schemas(spark, ["raw"])
    good = spark.createDataFrame([("a",)], "k string")
    sinks.overwrite_table(good, "raw.refreshed", ["k"])
    bad = spark.createDataFrame([("b",), (None,)], "k string")
    with pytest.raises(PySparkException, match="null in required column k"):
        sinks.overwrite_table(bad, "raw.refreshed", ["k"])
    assert [r.k for r in spark.table("raw.refreshed").collect()] == ["a"]
    sinks.overwrite_table(spark.createDataFrame([("c",)], "k string"), "raw.refreshed", ["k"])
    assert [r.k for r in spark.table("raw.refreshed").collect()] == ["c"]


def test_a_build_takes_other_code_lists(spark, scratch):
    from seriesmart.sources.codelists import CodeLists, load_seed

    measures = load_seed(spark, "seed_measure").withColumn("measure_name", F.upper("measure_name"))
    result = build(spark, Config(files.write(scratch)), CodeLists.standard(spark, measure=measures))
    found = {r[0] for r in result.series.select("measure_name").distinct().collect()}
    assert "EMPLOYED TOTAL" in found and "Employed total" not in found
