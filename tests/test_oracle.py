"""Every registered query against its DuckDB twin on the smallest scale."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from ledgerline.plans import queries as library
from tools.check_oracle import duck, rows_of

QUERIES = library.QUERIES
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "year", "month", "num_orders", "units_sold",
                          "total_revenue", "avg_order_value"]
    assert df.count() > 0
