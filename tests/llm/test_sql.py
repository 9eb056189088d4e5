"""Queries that SQL can express equal their DuckDB twin on the sf0.01 tables."""

import pytest

from shoplens.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare_frames, duckdb_connection
from tests.conftest import SF_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb_connection(SF_ORACLE)
    for table in ("documents", "embeddings"):
        con.sql(f"create or replace view {table} as select * from read_parquet('{SF_ORACLE}/{table}.parquet')")
    ok, msg = compare_frames(QUERIES[name](spark, SF_ORACLE), con, ORACLE_SQL[name])
    assert ok, msg
