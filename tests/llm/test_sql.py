"""Queries of the corpus operators against their SQL on the smallest scale."""

import pytest
from conftest import SF
from oracle_check import connect, differences

from __spark_entry__ import oracle_sql, queries
from urbanflux.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())
