"""Queries that SQL can express, against their SQL in a second engine."""

import pytest
from compare import connect, difference

from jobtide.llm.oracle import ORACLE_SQL
from jobtide.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) == ""
