"""Every registered query against its DuckDB oracle on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from hallowgrid.plans.catalog import ORACLES, QUERIES
from tools.check_oracles import TABLES, compare


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, sf, name):
    state, n, _, _, why = compare(spark, con, name, sf)
    assert state in ("ok", "rows-only", "EMPTY"), f"{state}: {why}"
    if state == "EMPTY":
        assert con.execute(entry.oracle_sql()[name]).fetchall() == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["kind", "geo", "impact", "n"] and df.count() > 0
