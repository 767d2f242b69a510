"""Queries of whole tables against their SQL, on the smallest test tables."""

import duckdb
import pytest

from lexispan.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_near_dedup", "op6_suffix_dedup"])
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    result = connection.execute(queries.LLM_ORACLES[name])
    columns = [c[0] for c in result.description]
    df = queries.LLM_QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, result.fetchall()))
