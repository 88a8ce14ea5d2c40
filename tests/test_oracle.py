"""Every registered query against its DuckDB twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def own_queries() -> list[str]:
    """All but the text operators, which have tests of their own."""
    text = registry.text_queries
    others = {*text.queries(), "pipeline"} if text else set()
    return [name for name in registry.queries() if name not in others]


def test_every_query_has_a_twin():
    assert set(own_queries()) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", own_queries())
def test_query(spark, duck, name):
    difference, rows, _ = compare(spark, duck, name, SF_DIR)
    assert difference is None
    assert rows > 0


def test_entry(spark):
    assert registry.entry(spark).columns[:2] == ["player_name", "season"]
