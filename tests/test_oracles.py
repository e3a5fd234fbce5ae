"""Every registered query against its SQL, on the test tables."""

import compare
import pytest

import __spark_entry__ as driver
from checks import oracles, queries

QUERIES = queries.all_queries()
ORACLES = oracles.all_oracles()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return compare.oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


def test_entry_gives_the_customer_dimension(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, connection):
    assert compare.differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None
