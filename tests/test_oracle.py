"""Spark queries against their DuckDB oracles on sf0.001 (the driver's gate runs sf0.01)."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of
from veracorp.plans.registry import all_oracles, all_queries
from veracorp.sources.tables import TABLES

ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sp = all_queries()[name](spark, SF_SMALL).toPandas()
    od = con.execute(ORACLES[name]).df()
    sc, sr = rows_of(sp)
    oc, orr = rows_of(od)
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr
