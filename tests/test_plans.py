"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL

from seriesmart.catalog import QUERIES


def scans_that_ran(df) -> set[str]:
    """The file scans of the executed plan.

    Adaptive execution prints initial plans as well; only what ran has been compiled, which shows
    as a numbered stage above the scan.
    """
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return {
        after.split("FileScan")[1]
        for line, after in zip(lines, lines[1:])
        if re.search(r"\*\(\d+\) ColumnarToRow", line) and "FileScan" in after
    }


@pytest.mark.parametrize("name", ["mart_national", "mart_ftpt"])
def test_national_marts_read_orders_once(spark, name):
    """Fact, series dimension and latest date share the one aggregation of orders."""
    assert len(scans_that_ran(QUERIES[name](spark, SF_SMALL))) == 1


@pytest.mark.parametrize("name", ["stg_labour_force", "fct_labour_force", "dim_series_decoded", "stg_dedupe", "dq_grain", "dq_overlap", "dq_fk", "diff_tables"])
def test_rows_are_never_gathered_in_one_partition(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["mart_national"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    assert schemas == {"o_orderstatus:string,o_orderdate:timestamp_ntz,o_orderpriority:string"}
