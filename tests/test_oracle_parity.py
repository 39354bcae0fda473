"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not available")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    srows = [tuple(r) for r in sdf.collect()]
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, rel.columns)[0]
