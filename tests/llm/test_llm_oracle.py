"""Queries that SQL can express, against DuckDB on whole tables."""
import duckdb
import pytest

from tickwise.llm import oracle, registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    want = con.execute(oracle.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    own = sorted(map(str, (tuple(r) for r in got.select(*names).collect())))
    assert own == sorted(map(str, want.fetchall()))
