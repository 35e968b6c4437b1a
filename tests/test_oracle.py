"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names and an order-insensitive hash of the values)."""

import duckdb
import pytest

import __spark_entry__ as E
from framelake import catalog
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest
from tools.type_check import SPARK_TO_DUCK

# the text operators, where present, have tests of their own in tests/llm
QUERIES, ORACLES = ({k: v for k, v in d.items() if k in catalog.QUERIES} for d in (E.queries(), E.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == {"list_chunks", "svd_topk"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__) for f in df.schema.fields}
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "detect_pct" in df.columns
