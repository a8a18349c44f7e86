"""The driver's correctness gate, run locally: every registered query against
its DuckDB SQL at sf0.01 (row count, column names, order-insensitive values)."""

import os

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as entry
from bucketlens.plans import catalog, oracle
from tools.check_oracle import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert len(catalog.queries()) == 47
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    s_rows = [r.asDict() for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    o_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    assert len(s_rows) == len(o_rows)
    assert rows_of(s_rows, cols) == rows_of(o_rows, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["bucket_name", "total_size"]
    assert 0 < df.count() <= 5
