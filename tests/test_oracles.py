"""Every registered query against its SQL on DuckDB."""

import duckdb
import pytest
from helpers import TESTDATA, duckdb_result, spark_result

import __spark_entry__ as entry_points
from fieldtally.catalog.registry import all_queries, all_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
        )
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, tables, key):
    result = spark_result(QUERIES[key](spark, SF_DIR))
    assert result == duckdb_result(tables, SQL[key])
    assert result[1], "the query returns no rows"


DUCKDB_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_column_types_equal(spark, tables, key):
    types = {c: DUCKDB_TYPES[t] for c, t in QUERIES[key](spark, SF_DIR).dtypes}
    described = tables.execute("DESCRIBE " + SQL[key]).fetchall()
    assert types == {row[0]: row[1] for row in described}


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["team", "n_hholds", "n_any_ag"]
    assert df.count() > 0
