"""Every query against its SQL on DuckDB, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from verification.compare import difference, duckdb_views
from verification.oracles import ORACLES
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_views(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLES.items() <= entry_module.oracle_sql().items()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, connection, sf_dir, name):
    assert difference(spark, connection, sf_dir, name) is None
