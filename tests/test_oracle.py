"""Every query with an SQL twin gives the same names, types and values."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, folder, con, name):
    assert compare(entry.queries()[name](spark, folder), con, ORACLES[name]) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_has_rows_and_columns(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 27 and df.count() == 150
