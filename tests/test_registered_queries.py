import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    found = difference(contract.queries()[name](spark, DATA), con, contract.oracle_sql()[name])
    assert found is None, found


def test_every_sql_belongs_to_a_query():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
