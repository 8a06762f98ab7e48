"""Versions of tables, partitions of the fact, lasting views and files with headers of their own order."""

from __future__ import annotations

import csv
import datetime as dt
import gzip
import re
import tempfile
from pathlib import Path

import fixture_files as files
import pytest
from conftest import SF_SMALL
from pyspark.errors import PySparkException

from seriesmart import sinks
from seriesmart.operators.reporting import select_facts, slice_facts
from seriesmart.operators.staging import deduplicated, typed_observations
from seriesmart.operators.star import FACT_PARTITIONS, dim_series, fct_observations
from seriesmart.plans.marts import INDUSTRY, NATIONAL, build_marts
from seriesmart.plans.views import mart_sql, staging_sql
from seriesmart.plans.warehouse import Config, build
from seriesmart.schemas import EXTRACTS, LABOUR_FORCE
from seriesmart.sources import observations as O
from seriesmart.sources import orders as B

BY_NAME = {e.name: e for e in EXTRACTS}


def rows_of(spark, name: str) -> list[str]:
    return sorted(r.k for r in spark.table(name).collect())


def refresh(spark, k: str) -> None:
    sinks.overwrite_table(spark.createDataFrame([(k,)], "k string"), "raw.versioned", ["k"])


@pytest.fixture
def versioned(spark):
    sinks.ensure_schemas(spark, ["raw"])
    spark.sql("DROP VIEW IF EXISTS raw.versioned")
    sinks.drop_versions(spark, "raw.versioned")
    refresh(spark, "old")
    return "raw.versioned"


# --- Refresh -------------------------------------------------------------------------------------


def test_a_refresh_switches_once_and_leaves_one_version(spark, versioned):
    refresh(spark, "new")
    assert rows_of(spark, versioned) == ["new"]
    assert sinks.versions(spark, versioned) == [sinks.current_version(spark, versioned)]


class Cut(BaseException):
    """What a killed driver looks like from inside: nothing after it runs."""


@pytest.mark.parametrize("step", ["write", "publish_version", "drop_versions"])
def test_a_crash_at_any_step_leaves_old_or_new(spark, versioned, monkeypatch, step):
    """The refresh is cut off at a step and no clean-up runs; the next one removes what is left."""

    def cut(*_):
        raise Cut

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "drop_versions", cut)
        if step == "write":
            df = spark.createDataFrame([("new",), (None,)], "k string")
            with pytest.raises(BaseException):
                sinks.overwrite_table(df, versioned, ["k"])
        else:
            patched.setattr(sinks, step, cut)
            with pytest.raises(Cut):
                refresh(spark, "new")
    assert rows_of(spark, versioned) == (["new"] if step == "drop_versions" else ["old"])
    refresh(spark, "next")
    assert rows_of(spark, versioned) == ["next"]
    assert len(sinks.versions(spark, versioned)) == 1


def test_a_failed_refresh_leaves_nothing_behind(spark, versioned):
    with pytest.raises(PySparkException, match="null in required column k"):
        sinks.overwrite_table(spark.createDataFrame([(None,)], "k string"), versioned, ["k"])
    assert rows_of(spark, versioned) == ["old"]
    assert sinks.versions(spark, versioned) == [sinks.current_version(spark, versioned)]


def test_a_plain_table_becomes_a_version(spark):
    sinks.ensure_schemas(spark, ["raw"])
    for kind in ("VIEW", "TABLE"):
        try:
            spark.sql(f"DROP {kind} IF EXISTS raw.plain")
        except PySparkException:
            pass
    spark.createDataFrame([("a",)], "k string").write.saveAsTable("raw.plain")
    with pytest.raises(PySparkException):
        sinks.overwrite_table(spark.createDataFrame([(None,)], "k string"), "raw.plain", ["k"])
    assert rows_of(spark, "raw.plain") == ["a"]
    sinks.overwrite_table(spark.createDataFrame([(1,)], "n int"), "raw.plain")
    assert spark.table("raw.plain").columns == ["n"]


def test_other_tables_with_a_like_name_stay(spark, versioned):
    spark.sql("CREATE OR REPLACE VIEW raw.versioned__note AS SELECT 1 AS k")
    refresh(spark, "new")
    assert spark.table("raw.versioned__note").count() == 1


# --- Partitioned fact ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    """A stored star of the order tables."""
    sinks.ensure_schemas(spark, ["core"])
    lf, account = B.lf_observations(spark, SF_SMALL), B.account_observations(spark, SF_SMALL)
    typed = typed_observations(lf, account)
    fact = fct_observations(deduplicated(typed), partitioned=True)
    stored = sinks.overwrite_table(fact, "core.fct_test", cluster_by=["series_id", "date_key"], partition_by=FACT_PARTITIONS)
    series = sinks.overwrite_table(dim_series(typed, B.code_lists(spark, SF_SMALL)), "core.dim_test")
    return stored, series


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_selections_prune_partitions(spark, star):
    fact, series = star
    for where, flow in ((NATIONAL, "LF"), (INDUSTRY, "ABS_LABOUR_ACCT")):
        plan = plan_of(select_facts(fact, series, where).select("date_key", "obs_value"))
        filters = re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
        assert "source_dataflow" in filters and flow in plan
        assert "ReadSchema: struct<series_id:string,date_key:date,obs_value:double>" in plan
    # Without a dataflow in the selection it is the selected series that prune, at run time.
    free = {k: v for k, v in INDUSTRY.items() if k != "source_dataflow"}
    found = select_facts(fact, series, free)
    assert "dynamicpruning" in plan_of(found)
    assert found.count() == select_facts(fact, series, INDUSTRY).count() > 0


def test_dates_prune_years(spark, star):
    fact, _ = star
    sliced = slice_facts(fact, dt.date(1996, 3, 1), dt.date(1997, 2, 1))
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan_of(sliced))[1]
    assert "period_year" in filters
    assert sliced.count() == fact.filter("date_key BETWEEN DATE '1996-03-01' AND DATE '1997-02-01'").count() > 0
    plain = fact.drop("period_year")
    assert slice_facts(plain, dt.date(1996, 3, 1)).count() == fact.filter("date_key >= DATE '1996-03-01'").count()


def test_facts_with_foreign_ids_are_selected(spark):
    """A selection follows the series dimension, whatever its ids look like."""
    fact = spark.createDataFrame(
        [("any id", dt.date(2020, 1, 1), 1.0, "LF", 2020), ("LF.M3.x", dt.date(2020, 1, 1), 2.0, "LF", 2020)],
        "series_id string, date_key date, obs_value double, source_dataflow string, period_year int",
    )
    series = spark.createDataFrame(
        [("any id", "LF", "M3"), ("LF.M3.x", "LF", "M6")], "series_id string, source_dataflow string, measure_code string"
    )
    where = {"source_dataflow": "LF", "measure_code": ["M3"]}
    for rows in (fact, fact.drop("source_dataflow", "period_year")):
        assert [r.obs_value for r in select_facts(rows, series, where).collect()] == [1.0]


def test_a_revised_year_replaces_its_partitions_only(spark):
    sinks.ensure_schemas(spark, ["core"])
    schema = "series_id string, obs_value double, source_dataflow string, period_year int"
    first = spark.createDataFrame([("a", 1.0, "LF", 2020), ("b", 2.0, "LF", 2021), ("c", 3.0, "X", 2021)], schema)
    options = {"cluster_by": ["series_id"], "partition_by": FACT_PARTITIONS}
    sinks.overwrite_partitions(first, "core.revised", **options)
    late = spark.createDataFrame([("b2", 5.0, "LF", 2021), ("d", 6.0, "LF", 2022)], schema)
    sinks.overwrite_partitions(late, "core.revised", **options)
    assert sorted(r.series_id for r in spark.table("core.revised").collect()) == ["a", "b2", "c", "d"]
    assert len(sinks.versions(spark, "core.revised")) == 1


# --- Views ---------------------------------------------------------------------------------------


def test_views_say_what_the_frames_say(spark, star):
    fact, series = star
    marts = build_marts(fact, series).by_name()
    for name, sql in mart_sql("core.fct_test", "core.dim_test").items():
        view = spark.sql(sql)
        assert view.schema.simpleString() == marts[name].schema.simpleString()
        assert sorted(map(repr, view.collect())) == sorted(map(repr, marts[name].collect())) != []


def test_staging_view_says_what_the_frame_says(spark):
    lf = B.lf_observations(spark, SF_SMALL)
    account = B.account_observations(spark, SF_SMALL)
    lf.createOrReplaceTempView("lf_for_view")
    account.createOrReplaceTempView("account_for_view")
    view = spark.sql(staging_sql("lf_for_view", "account_for_view"))
    staged = deduplicated(typed_observations(lf, account))
    assert view.columns == staged.columns
    assert sorted(map(repr, view.collect())) == sorted(map(repr, staged.collect())) != []


def test_another_session_reads_the_views(spark, scratch):
    built = build(spark, Config(files.write(scratch), write_all=False))
    other = spark.newSession()
    for name, mart in built.marts.by_name().items():
        assert other.catalog.getTable(f"mart.{name}").tableType == "VIEW"
        assert sorted(map(repr, other.table(f"mart.{name}").collect())) == sorted(map(repr, mart.collect())) != []
    assert other.table("staging.stg_labour_force").count() == built.staged.count()
    assert sinks.versions(spark, "mart.v_national_overview") == []
    # The views follow the next refresh of the tables below them, and give way to tables again.
    build(spark, Config(scratch))
    assert other.table("mart.v_national_overview").count() == len(files.MONTHS)
    assert len(sinks.versions(spark, "mart.v_national_overview")) == 1


# --- Headers -------------------------------------------------------------------------------------


def parts(directory: str, header: list[str], rows: list[list], orders: list[list[int]]) -> str:
    """A folder of part files, each with its own order of columns."""
    folder = Path(directory) / "state_summary.csv"
    folder.mkdir()
    for k, order in enumerate(orders):
        name = folder / f"part {k}.csv"
        with open(name, "w", newline="", encoding="utf-8") as out:
            out.write("﻿" if k == 1 else "")
            writer = csv.writer(out)
            writer.writerow([header[i] for i in order])
            writer.writerows([[r[i] for i in order] for r in rows[k :: len(orders)]])
    return str(folder)


def test_files_of_one_extract_order_their_columns_differently(spark, scratch):
    header, rows = files.contents()["state_summary"]
    natural = list(range(len(header)))
    path = parts(scratch, header, rows, [natural, natural[::-1], natural[3:] + natural[:3], natural[::-1]])
    found = O.files_by_header(spark, path)
    assert sorted(len(f) for f in found.values()) == [1, 1, 2]
    got = O.read_extract(spark, scratch, BY_NAME["state_summary"])
    whole = files.write(tempfile.mkdtemp(prefix="run-"), {"state_summary_whole": (header, rows)})
    text = O.read_csv_strings(spark, f"{whole}/state_summary_whole.csv")
    expected = O.typed_extract(text, "state_summary", O.raw_schema(LABOUR_FORCE))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect())) != []


def test_each_header_is_still_enforced(spark, scratch):
    header, rows = files.contents()["state_summary"]
    natural = list(range(len(header)))
    path = parts(scratch, header, rows, [natural, natural[::-1]])
    with open(f"{path}/part 0.csv", "a", encoding="utf-8") as out:
        out.write("a,row,too,short\n")
    with pytest.raises(Exception, match="MALFORMED"):
        O.read_extract(spark, scratch, BY_NAME["state_summary"]).collect()


def test_a_file_without_a_wanted_column_is_refused(spark, scratch):
    header, rows = files.contents()["state_summary"]
    natural = list(range(len(header)))
    parts(scratch, header, rows, [natural, [i for i in natural if header[i] != "REGION"]])
    with pytest.raises(ValueError, match="missing expected columns"):
        O.read_extract(spark, scratch, BY_NAME["state_summary"])


def test_headers_of_compressed_and_empty_files(spark, scratch):
    folder = Path(scratch) / "f.csv"
    folder.mkdir()
    with gzip.open(folder / "a.csv.gz", "wt", encoding="utf-8") as out:
        out.write("A,B\n1,2\n")
    (folder / "b.csv").write_text("B,A\n4,3\n")
    (folder / "c.csv").write_text("")
    frames = O.csv_parts(spark, str(folder))
    rows = sorted((r.A, r.B) for f in frames for r in f.select("A", "B").collect())
    assert rows == [("1", "2"), ("3", "4")]
