"""Every registered query equals its SQL on the given tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import connect, difference
from tagloom.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    profile = entry(spark)
    assert profile.columns == ["userId", "tagsId"]
    assert profile.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())
