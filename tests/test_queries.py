"""Every query next to its SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark, sf_dir):
    assert contract.entry(spark).count() == 6
