"""Queries of the training-data operators against their SQL, over whole tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from conftest import SF_SMALL  # noqa: E402
from oracle_check import compare, connect  # noqa: E402

from seriesmart.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    verdict, rows = compare(QUERIES[name](spark, SF_SMALL), connect(SF_SMALL), ORACLES[name])
    assert verdict == "ok" and rows
