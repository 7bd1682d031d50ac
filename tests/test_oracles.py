"""Every query of the warehouse against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import stream_queries
import warehouse_oracles
import warehouse_queries
from check_oracles import compare, connect

QUERIES = {**warehouse_queries.QUERIES, **stream_queries.QUERIES}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    assert compare(spark, duck, name, sf).startswith("ok ")


def test_every_query_has_its_sql():
    assert set(warehouse_oracles.ORACLES) == set(QUERIES)


def test_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
