from __future__ import annotations

import pytest

import __spark_entry__ as E
from blotter.llm import registry
from tests.conftest import SMOKE_DIR
from tests.test_entry import compare, duckdb_views


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SMOKE_DIR)


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES) <= set(E.queries()) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_its_sql(spark, duck, name):
    out = compare(spark, duck, name, registry.QUERIES[name], registry.SQL[name], SMOKE_DIR)
    assert out["ok"], out["problems"]
    assert out["rows"] > 0
