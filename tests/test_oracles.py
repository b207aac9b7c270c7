"""Every query equals its SQL, here on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tallyline.plans.oracles import ORACLES
from tallyline.plans.queries import QUERIES
from tests.check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1
