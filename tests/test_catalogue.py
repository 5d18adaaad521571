"""Every catalogue query against its independent SQL answer."""

import pytest

import __spark_entry__ as entry
from hangarflow.plans import catalogue
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(catalogue.SQL)
ROWS_ONLY = sorted(set(catalogue.QUERIES) - set(catalogue.SQL))


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.columns and df.collect()


def test_entry_has_87_columns(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 87
    assert df.count() > 0


def test_entry_registers_the_whole_catalogue():
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(catalogue.SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
