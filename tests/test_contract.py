"""Driver contract: entry() runs, every query of the profile library has an oracle, and all match DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from assetlens.plans import QUERIES
from tools.check_oracle import TABLES, digest

from sf_dirs import SF001


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["model_id", "entity_id", "segment_key", "host_ips", "n_ips"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows) > 0
    assert digest(df.columns, s_rows)[0] == digest(rel.columns, d_rows)[0]
