"""Every query with an SQL counterpart, over the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, db, name):
    found = queries()[name](spark, FOLDER).toPandas()
    assert differences(found, db.sql(oracle_sql()[name]).df()) == ""
    assert len(found)


def test_sql_is_for_known_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    hits = entry(spark)
    assert hits.columns == ["query_id", "rank", "doc_id", "score"]
    assert hits.select("query_id").distinct().count() == 40
