"""Every registered query against its SQL twin, or for a stable schema where it has none."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tidewright.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_entry(spark):
    df = contract.entry(spark)
    assert "doc_id" in df.columns and not df.isEmpty()
    assert set(contract.oracle_sql()) <= set(contract.queries())
