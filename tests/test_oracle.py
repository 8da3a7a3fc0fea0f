"""Every registered query against its SQL on the smallest scale."""

import pytest
from conftest import SF
from oracle_check import connect, differences

from __spark_entry__ import entry
from urbanflux.plans.oracle import ORACLE
from urbanflux.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLE[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
