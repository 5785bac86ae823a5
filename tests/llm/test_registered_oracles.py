"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from lodestar.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    frame = QUERIES[name](spark, SF)
    assert frame.columns == columns
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_all_queries_are_registered():
    names = set(E.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
