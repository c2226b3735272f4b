"""Every registered query against its SQL oracle on the shared test tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(contract._QUERIES) == set(contract._ORACLES)


@pytest.mark.parametrize("name", sorted(contract._QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert differences(result, con, contract.oracle_sql()[name]) == []


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema
    assert not first.isEmpty()
