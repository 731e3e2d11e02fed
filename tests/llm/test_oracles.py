"""The queries that have SQL, against DuckDB."""

import duckdb
import pytest

from quaystar.llm.oracle import ORACLES
from quaystar.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, rows, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    relation = connection.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    expected = relation.project(", ".join(f'"{column}"' for column in columns)).fetchall()
    assert rows(found, *columns) == sorted(expected, key=str)
