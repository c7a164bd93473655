"""Every registered query against its SQL, row by row and bit by bit."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from lidarframe.plans.catalog import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["lineitem", "events", "part"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [tuple(repr(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(named)


def test_keys_agree():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    found = normal(result.columns, [tuple(r) for r in result.collect()])
    relation = duck.sql(oracle_sql()[name])
    expected = normal(relation.columns, relation.fetchall())
    assert found[0] == expected[0]
    types = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}
    assert dict(result.dtypes) == {c: types[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert len(found[1]) == len(expected[1])
    assert found[1] == expected[1]


def test_entry(spark):
    row = entry_module.entry(spark).first()
    assert row["points"] == 6000
