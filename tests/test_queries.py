"""Every registered query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    problem = difference(entry.queries()[name](spark, SF_DIR), connection, entry.oracle_sql()[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
