"""Every registered query against its oracle SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")
# the operators for training data have their own tests
NAMES = {name for c in entry._CATALOGS if c.__name__.startswith("opsledger.catalog") for name in c.QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in NAMES}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, con, name):
    problem, rows, _ = compare(spark, con, FOLDER, entry.queries()[name], SQL[name])
    assert problem is None
    assert rows > 0


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())
    assert NAMES - set(SQL) == {"als_top10"}
