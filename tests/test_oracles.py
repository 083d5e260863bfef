"""Every query against its SQL twin, over whole tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from inspectstar.oracles import ORACLES
from inspectstar.queries import QUERIES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')"
        )
    yield connection
    connection.close()


def _comparable(rows, columns):
    positions = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(row[i]) for i in positions) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    twin = database.execute(ORACLES[name])
    columns = [c[0] for c in twin.description]
    assert sorted(result.columns) == sorted(columns)
    got = _comparable(map(tuple, result.collect()), result.columns)
    assert got == _comparable(twin.fetchall(), columns)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 4180


def test_sorted_query_is_in_order(spark):
    rows = QUERIES["sort_asc_nulls_first"](spark, SF_DIR).collect()
    keys = [(r[0] is not None, r[0] or "", r[1] is not None, r[1] or "") for r in rows]
    assert keys == sorted(keys)
    assert rows[0][0] is None
