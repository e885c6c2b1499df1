"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tillwork import catalog
from tests.compare import difference

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, folder, duck):
    assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_every_report_has_sql():
    assert set(catalog.queries()) <= set(ORACLES)


def test_no_sql_without_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "today_growth_pct" in df.columns
