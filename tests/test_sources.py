from __future__ import annotations

import fixture_files
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seriesmart.schemas import EXTRACTS, LABOUR_ACCOUNT, LABOUR_FORCE, LF_DIMENSIONS, NA_TOKENS, RAW_LF
from seriesmart.sinks import write_slice
from seriesmart.sources import observations as O
from seriesmart.sources.codelists import SEED_ROWS, SEED_SCHEMAS, load_seed

BY_NAME = {e.name: e for e in EXTRACTS}


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    return fixture_files.write(str(tmp_path_factory.mktemp("raw")))


def test_read_all_extracts(spark, raw_dir):
    lf = O.read_observations(spark, raw_dir, LABOUR_FORCE)
    account = O.read_observations(spark, raw_dir, LABOUR_ACCOUNT)
    assert lf.schema.fieldNames() == RAW_LF.fieldNames()
    assert [f.dataType for f in lf.schema.fields] == [f.dataType for f in RAW_LF.fields]
    months = len(fixture_files.MONTHS)
    assert lf.count() == months * (5 + 9 + 16 + 2)
    assert account.count() == len(fixture_files.INDUSTRIES) * 3
    assert lf.filter("obs_value is null").count() == 1
    assert {r[0] for r in lf.select("unit_mult").distinct().collect()} == {0, 3}


def test_numbers_come_back_exactly(spark, raw_dir):
    rows = O.read_extract(spark, raw_dir, BY_NAME["state_summary"]).collect()
    for r in rows:
        i = fixture_files.MONTHS.index(r.time_period)
        assert r.obs_value == fixture_files.level(r.measure, r.sex, r.region, i)


def test_missing_file_and_missing_column(spark, scratch):
    with pytest.raises(O.MissingExtract):
        O.read_extract(spark, scratch, BY_NAME["national_trend"])
    fixture_files.write(scratch, {"national_trend": (["MEASURE", "SEX"], [["M3", "3"]])})
    with pytest.raises(ValueError, match="missing expected columns"):
        O.read_extract(spark, scratch, BY_NAME["national_trend"])


def test_na_tokens_and_bad_numbers(spark):
    texts = [*NA_TOKENS, "12.5", " 7 ", "1e3", "-.5", "abc", "1.5d", "0x10", "1,000", "Infinity"]
    df = O.null_tokens(spark.createDataFrame([(t,) for t in texts], "v string"))
    values = [r.v for r in O.coerce_numeric(df, doubles=["v"]).collect()]
    assert values == [None] * len(NA_TOKENS) + [12.5, 7.0, 1000.0, -0.5] + [None] * 5


def test_whole_numbers(spark):
    df = spark.createDataFrame([("3",), ("3.0",), ("x",), (None,)], "n string")
    assert [r.n for r in O.coerce_numeric(df, integers=["n"]).collect()] == [3, 3, None, None]
    with pytest.raises(PySparkException, match="not a whole number"):
        O.coerce_numeric(spark.createDataFrame([("3.5",)], "n string"), integers=["n"]).collect()


def test_series_selection_matches_brute_force(spark, raw_dir):
    lf = O.read_observations(spark, raw_dir, LABOUR_FORCE)
    rows = lf.collect()
    for key in ("M3+M13.3.1599.30.1+2.M", "M3.3..20.AUS.M", ".....", "M1.1+2.1599.20.AUS.M", "M99.3.1599.20.AUS.M"):
        wanted = [set(p.split("+")) if p else None for p in key.split(".")]
        expected = sum(
            all(w is None or r[c] in w for c, w in zip(LF_DIMENSIONS, wanted)) for r in rows
        )
        assert O.select_series(lf, LF_DIMENSIONS, key).count() == expected
    with pytest.raises(ValueError):
        O.select_series(lf, LF_DIMENSIONS, "M3.3")


def test_member_counts_ignore_nulls_and_report_empty_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None), ("a", None)], "x string, y string")
    rows = {r.dimension: (r.expected, r.actual, r.is_complete) for r in O.check_member_counts(df, {"x": 2, "y": 1}).collect()}
    assert rows == {"x": (2, 2, 1), "y": (1, 0, 0)}
    found = {(r.dimension, r.member) for r in O.members_found(df, ["x", "y"]).collect()}
    assert found == {("x", "a"), ("x", "b")}


def test_ingest_report_and_failure_at_the_end(spark, raw_dir):
    lf = O.read_observations(spark, raw_dir, LABOUR_FORCE)
    monthly = [e for e in EXTRACTS if e.dataflow == LABOUR_FORCE]
    report = O.ingest_report(lf, monthly)
    assert {r.status for r in report.collect()} == {"ok"}
    O.raise_on_problems(report)
    short = lf.filter("region <> '8' and source_extract <> 'national_trend'")
    report = O.ingest_report(short, monthly)
    assert {r.source_extract: r.status for r in report.collect()} == {
        "national_summary": "ok", "national_fulltime_parttime": "ok",
        "state_summary": "incomplete", "national_trend": "failed",
    }
    with pytest.raises(RuntimeError, match=r"national_trend: failed; state_summary: incomplete \(expected 8 distinct region, got 7: 1, 2, 3, 4, 5, 6, 7\)"):
        O.raise_on_problems(report)


def test_slice_round_trip_keeps_regions(spark, raw_dir, scratch):
    text = O.read_csv_strings(spark, f"{raw_dir}/state_summary.csv")
    sliced = O.slice_from_year(text, 2021, "TIME_PERIOD")
    write_slice(sliced, f"{scratch}/state_summary.csv")
    again = O.read_extract(spark, scratch, BY_NAME["state_summary"])
    assert again.count() == 12 * 16
    (regions,) = O.check_member_counts(again, {"region": 8}).collect()
    assert regions.is_complete == 1


def test_code_lists_are_typed_and_local(spark):
    for name, rows in SEED_ROWS.items():
        df = load_seed(spark, name)
        assert df.schema == SEED_SCHEMAS[name]
        assert sorted(map(tuple, df.collect())) == sorted(rows)
        assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    joined = spark.range(5).withColumn("sex_code", F.col("id").cast("string")).join(load_seed(spark, "seed_sex"), "sex_code", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def _folder(scratch: str, *parts: str) -> str:
    for k, text in enumerate(parts):
        with open(f"{scratch}/part-{k}.csv", "w") as out:
            out.write(text)
    return scratch


@pytest.mark.parametrize(
    "parts",
    [
        ("MEASURE,SEX\nM3,1\n", "SEX,MEASURE\n2,M3\n"),
        ("MEASURE,SEX\nM3,1,9\n",),
        ("MEASURE,SEX\nM3\n",),
    ],
    ids=["headers in another order", "row too long", "row too short"],
)
def test_csv_scan_is_strict(spark, scratch, parts):
    with pytest.raises(Exception, match="CSV header|MALFORMED|Malformed|FAILED_READ_FILE"):
        O.read_csv_strings(spark, _folder(scratch, *parts)).collect()


def test_slice_keeps_annual_rows(spark):
    df = spark.createDataFrame([("2010",), ("2014-12",), ("2015-01",)], "time_period string")
    assert sorted(r[0] for r in O.slice_from_year(df, 2015).collect()) == ["2010", "2015-01"]
