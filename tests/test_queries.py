"""Every registered query against its reference SQL on DuckDB."""

import pytest
from compare import connect, differences
from conftest import SF

import __spark_entry__ as contract
from poolscope.plans.queries import QUERIES
from poolscope.plans.reference_sql import REFERENCE_SQL


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(REFERENCE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert differences(spark, connection, contract.queries()[name], contract.oracle_sql()[name], SF) == []


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
