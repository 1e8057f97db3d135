"""The registered queries against their SQL on the smallest tables."""

import collections

import duckdb
import pytest

from quarryline.llm import queries

SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def sql(data):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, sql, name):
    df = queries.queries()[name](spark, data)
    columns = sorted(df.columns)
    cursor = sql.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = collections.Counter(tuple(r[i] for i in at) for r in cursor.fetchall())
    assert collections.Counter(tuple(r[c] for c in columns) for r in df.collect()) == expected


def test_all_are_registered(spark):
    import __spark_entry__ as contract

    assert {*queries.queries(), "pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
