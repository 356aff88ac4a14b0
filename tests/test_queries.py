"""Every registered query against its check SQL, and a contract check."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@needs_data
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


@needs_data
@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


@needs_data
def test_entry(spark):
    assert entry.entry(spark).columns == [
        "day", "error_type", "prompt_version", "error_count", "total_requests", "error_rate_pct"
    ]


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
