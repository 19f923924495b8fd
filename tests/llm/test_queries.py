import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from assetlens.llm import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    from check_oracle import digest

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[1] == digest(rel.columns, rel.fetchall())[1]


@pytest.mark.parametrize("name", ["op1_fingerprints", "op6_quality_model", "op7_language"])
def test_query_covers_every_document(spark, name):
    df = QUERIES[name](spark, SF)
    assert sorted(r["doc_id"] for r in df.collect()) == list(range(200))
