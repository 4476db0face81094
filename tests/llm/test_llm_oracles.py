"""Registered queries with SQL, against DuckDB on the same tables."""

import duckdb
import pytest

from hallowgrid.llm.queries import ORACLES
from tools.check_oracles import TABLES, compare


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf, name):
    state, n, _, _, why = compare(spark, con, name, sf)
    assert state == "ok" and n > 0, why
