"""Every registered query against the same question asked of DuckDB."""

import pytest

import __spark_entry__ as contract
from cabrank.plans.catalogue import QUERIES
from cabrank.plans.oracle import ORACLE
from compare import connect, differences
from conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert differences(df, oracle, contract.oracle_sql()[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [tuple(row) for row in rows] == [("NATION_19", "NATION_5", 71801.43)]
