"""Queries with SQL equal it over the smallest tables."""

import duckdb
import pytest

from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(cursor.fetchall(), key=repr)
