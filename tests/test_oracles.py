"""Every registered table query against DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry
from tests.check_oracles import connect, differences
from workloads import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert differences(db, QUERIES[name](spark, FOLDER), ORACLES[name]) == ""


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
