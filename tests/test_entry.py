"""Driver contract: entry() runs, and every registered query matches its SQL oracle."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from facetspark.plans.catalogue import ORACLE_SQL, QUERIES
from tools.oracle_check import SPARK_TO_DUCK, TABLES, _rows

from .conftest import SF001


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "tagged_as"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE_SQL) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_module.queries()[name](spark, SF001)
    rel = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == types[f.name], f.name
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(list(rel.columns), rel.fetchall())
