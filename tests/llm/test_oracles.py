"""Queries of the training-data operators against their SQL on the smallest tables."""

import duckdb
import pytest
from plaza.llm import oracles, queries


@pytest.mark.parametrize("name", list(oracles.SQL))
def test_query_equals_its_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "clients", "sales", "sale_lines", "vendors", "nation"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    out = con.execute(oracles.SQL[name])
    names = [d[0] for d in out.description]
    rows = queries.QUERIES[name](spark, small).select(names).collect()
    assert sorted(repr(tuple(r)) for r in rows) == sorted(map(repr, out.fetchall()))
