"""Every registered query against its SQL, on the smallest of the given folders."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from verification.compare import connect, differences
from verification.oracle import ORACLE
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["movie_id", "title", "release_year", "total_ratings", "avg_rating"]
    assert df.count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    assert differences(spark, con, name, SF) is None
