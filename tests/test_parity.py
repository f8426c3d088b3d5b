"""Every registered query against its oracle SQL on the smallest tables."""

import pytest
from parity import compare, oracle

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_oracle(spark, connection, sf_dir, key):
    match, _, message = compare(spark, connection, QUERIES[key], ORACLES[key], sf_dir)
    assert match, message


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:2] == ["route_id_extracted", "stop_id"] and result.count() > 0
