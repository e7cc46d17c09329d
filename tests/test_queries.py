"""Every registered query against its SQL in a second engine."""

import pytest
from compare import connect, difference

from jobtide.checks.oracle import ORACLE_SQL
from jobtide.checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_check():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, frames, con):
    assert difference(QUERIES[name](frames), con, ORACLE_SQL[name]) == ""


def test_driver_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["role_title", "tool", "n_jobs"]
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql())
