"""Every registered query against its SQL on the smallest tables, and against the plan rules."""

import collections

import duckdb
import pytest

import __spark_entry__ as contract
from quarryline.plans import catalog, oracles

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = catalog.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def sql(data):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, sql, name):
    df = QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(df.columns)
    rows = collections.Counter(tuple(r[c] for c in columns) for r in df.collect())
    cursor = sql.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == collections.Counter(tuple(r[i] for i in at) for r in cursor.fetchall())


def test_entry(spark, data):
    assert contract.entry(spark).count() == 1
