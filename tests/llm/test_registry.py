"""Queries that SQL can express, against that SQL."""

import duckdb
import pytest
from check import differences

import corpus_pipeline  # noqa: F401
from wattloom.llm.base import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert differences(QUERIES[name](spark, FOLDER).toPandas(), con.sql(ORACLE[name]).df()) == []


def test_all_are_registered():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]) if n[:2] == "op" else 0)] == ["pipeline", *(f"op{k}" for k in range(1, 14))]
