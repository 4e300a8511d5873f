"""Every registered query equals its SQL on the smallest tables."""

import pytest

import check_queries
from __spark_entry__ import entry, queries
from catalogue import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(FOLDER)


def test_names():
    assert set(ORACLE) == set(QUERIES) <= set(queries())
    assert len(QUERIES) > 100


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    outcome = check_queries.compare(spark, con, name, FOLDER)
    assert outcome.startswith("equal"), outcome
