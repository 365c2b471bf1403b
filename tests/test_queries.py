"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
from gridtide.plans.queries import CATALOG
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert CATALOG.keys() <= contract.queries().keys() & contract.oracle_sql().keys()


@pytest.mark.parametrize("name", CATALOG)
def test_query_equals_sql(spark, con, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert differences(frame, con, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
