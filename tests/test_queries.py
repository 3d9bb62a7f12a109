"""Every registered query against its SQL, on the whole smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()
OWN = {query.__name__ for query in registry.QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _comparable(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in row) for row in rows)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in SQL])
def test_query_equals_sql(spark, sql, name):
    found = registry.queries()[name](spark, TABLES)
    columns = ", ".join(f'"{c}"' for c in sorted(found.columns))
    expected = sql.execute(f"SELECT {columns} FROM ({SQL[name]})").fetchall()
    assert _comparable(found.select(*sorted(found.columns)).collect()) == _comparable(expected)


def test_all_core_queries_have_sql():
    assert set(SQL) >= OWN
    assert set(SQL) <= set(registry.queries())


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["word", "closest_word"] and result.count() > 0
