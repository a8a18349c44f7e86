"""Queries that SQL can express against DuckDB at sf0.01."""

import duckdb
import pytest

from llm_fixtures import SF001, shipped  # noqa: F401

from bucketlens.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import rows_of


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    rel = con.sql(ORACLE_SQL[name])
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    got = [r.asDict() for r in QUERIES[name](spark, SF001).collect()]
    assert sorted(rel.columns) == sorted(got[0])
    cols = sorted(rel.columns)
    assert rows_of(got, cols) == rows_of(want, cols)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
