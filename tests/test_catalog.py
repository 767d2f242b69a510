"""Every registered query against its SQL on the smallest test tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "conversations"]


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_equivalent():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and [r.result for r in rows][0].startswith("(")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = sql.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, result.fetchall()))
