import duckdb
import pytest

from facetspark.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, sf001, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    got, want = QUERIES[name](spark, sf001), con.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = want.project(", ".join(columns)).fetchall()
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(rows) and rows
