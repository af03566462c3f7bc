"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from figcurate.plans import curation_queries, data_queries, stage_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = [*data_queries.QUERIES, *curation_queries.QUERIES, *stage_queries.QUERIES]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain(value):
    if isinstance(value, dict):
        return tuple(sorted((plain(k), plain(v)) for k, v in value.items()))
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return round(value, 6) if isinstance(value, float) else value


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, database, name):
    found = entry.queries()[name](spark, FOLDER)
    got = rows(found.columns, [tuple(r) for r in found.collect()])
    if name in entry.oracle_sql():
        result = database.sql(entry.oracle_sql()[name])
        assert sorted(found.columns) == sorted(result.columns)
        assert got == rows(result.columns, result.fetchall())
    else:
        assert len(set(map(repr, got))) == len(got)


def test_entry(spark):
    assert entry.entry(spark).columns == ["pmcid", "figure_id"]
    assert len({*NAMES}) == len(NAMES) and set(entry.oracle_sql()) <= set(entry.queries())
