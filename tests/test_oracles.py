"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import glob
import os

import pytest

from oracles.queries import oracle_sql
from quaystar.plans.catalogue import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
EXPECTED = oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, rows, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    relation = database.sql(EXPECTED[name])
    assert sorted(relation.columns) == columns
    expected = relation.project(", ".join(f'"{column}"' for column in columns)).fetchall()
    assert rows(found, *columns) == sorted(expected, key=str)
