"""Every registered query against its SQL, on the smallest test tables."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, differences, type_differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(entry_points.training_data()[0])))
def test_query_equals_sql(spark, db, name):
    sql = entry_points.oracle_sql().get(name)
    df = entry_points.queries()[name](spark, SF_DIR)
    found = df.toPandas()
    assert len(found) > 0
    if sql is not None:
        assert differences(found, db.execute(sql).df()) is None
        assert type_differences(df, db, sql) is None


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


def test_other_queries_live_without_the_training_data_modules(monkeypatch):
    monkeypatch.setitem(sys.modules, "millrace.llm.queries", None)  # as if one of its libraries were missing
    with pytest.warns(UserWarning, match="left out"):
        found = entry_points.queries()
    assert set(found) == set(entry_points.catalog.QUERIES) and "silver_features" in found
