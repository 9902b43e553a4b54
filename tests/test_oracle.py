"""Every registered query against its DuckDB oracle at sf0.001 (the
driver's check runs the same comparison at sf0.01)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from donorlake.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in E.queries().items() if k in registry.QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registry.QUERIES}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_contract(spark):
    assert set(ORACLE) <= set(QUERIES)
    df = E.entry(spark)
    assert df.columns == ["source", "n_contributions"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        return
    res = duck.execute(ORACLE[name])
    sc, sr = rows_of(df.columns, srows)
    dc, dr = rows_of([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
