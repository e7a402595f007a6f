"""Every registered query against its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from ledgerlens.catalog import QUERIES, SQL
from oracle_harness import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, small, name):
    res = compare(spark, duck_small, name, QUERIES[name], SQL.get(name), small)
    if SQL.get(name) is None:
        assert res["rows"] >= 0
        return
    assert res["cols_match"], res
    assert res["match"], res


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["month", "tx_count"]
