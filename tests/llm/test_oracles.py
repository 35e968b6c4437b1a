"""Queries that SQL can express, against their SQL on sf0.001."""

import duckdb
import pytest

from framelake.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})")
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())
