"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import json
import re

import pytest
from conftest import SF_SMALL
from oracle_check import compare, connect

import __spark_entry__ as entry
from seriesmart.catalog import QUERIES
from seriesmart.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    verdict, _ = compare(df, con, ORACLES[name])
    assert verdict == "ok"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroupsInPandas|ArrowEval", plan)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_figures_document(spark):
    (row,) = QUERIES["figures_json"](spark, SF_SMALL).collect()
    document = json.loads(row.figures)
    assert list(document) == [
        "period", "headline", "turning_point", "eras", "before_turn", "after_turn",
        "since_1995_naive", "levels", "male_parttime", "pace",
    ]
    (headline,) = QUERIES["headline"](spark, SF_SMALL).collect()
    assert document["headline"]["gap_now"] == headline.gap_now
    assert [e["era"] for e in document["eras"]] == [
        r.era for r in QUERIES["era_changes"](spark, SF_SMALL).collect()
    ]
