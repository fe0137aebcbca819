"""Every named query against its SQL on the smallest tables."""

import __spark_entry__ as driver
import compare
import pytest

# The library's own queries; those of the text operators have tests of their own.
QUERIES, ORACLES = driver.QUERIES, driver.oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_query_equals_sql(spark, duck, sf_dir, name):
    problems = compare.differences(spark, duck, QUERIES[name], ORACLES[name], sf_dir)
    assert [p for p in problems if p != "no rows"] == []


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
