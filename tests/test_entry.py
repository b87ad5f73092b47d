"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE_DIR

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import compare, duckdb_views  # noqa: E402


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["Year", "Month", "Total Crimes", "Top Number"]
    assert df.count() > 0


REPORTS = sorted(name for name in E.queries() if name.startswith("q"))


def test_every_report_has_an_oracle():
    assert set(REPORTS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SMOKE_DIR)


@pytest.mark.parametrize("name", REPORTS)
def test_query_matches_oracle(spark, duck, name):
    out = compare(spark, duck, name, E.queries()[name], E.oracle_sql()[name], SMOKE_DIR)
    assert out["ok"], out["problems"]
    assert out["rows"] > 0
