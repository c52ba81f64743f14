"""Every catalogued query against its SQL twin, and the driver contract."""

import __spark_entry__ as contract
import pytest
from compare import connect, differences
from tidewire.plans import catalogue, oracles

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == ""


def test_all_queries_of_the_core_have_sql():
    assert set(catalogue.queries()) == set(oracles.oracle_sql())
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "computed_metric" in df.columns
