"""Every catalog query against its SQL counterpart."""

import pytest
from oracle import connect, differences

import __spark_entry__ as contract
from jangbu.plans.catalog import QUERIES
from jangbu.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["level", "district_name"] and df.count() > 0
