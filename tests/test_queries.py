"""Every registered query with an expected-result statement, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_statement(spark, duck, sf, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert compare(got, want) == ""


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["txn_id", "txn_ts"] and df.count() == 100
