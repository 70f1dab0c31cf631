"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SF
from tidemark.plans import catalog, oracles
from tests.oracle_check import connect, difference

ORACLES = oracles.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], sf) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["date", "event_type", "event_cnt", "actor_cnt"]
    assert df.count() > 0
