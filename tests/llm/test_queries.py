"""Registered training-data queries against their DuckDB oracle on the smallest data."""

import duckdb
import pytest

from geonest.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = LLM_QUERIES[name](spark, SF)
    want = con.sql(LLM_ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
