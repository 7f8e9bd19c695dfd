"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from gameflow.plans import catalog
from tests.oracle_check import actual, duck, expected

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    assert actual(contract.queries()[name](spark, SF_DIR)) == expected(con, contract.oracle_sql()[name])


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 1000
