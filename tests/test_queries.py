"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from workloads.check import compare, duck
from workloads.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["ip", "domains", "last_seen", "country", "city"] and out.count() > 0
