"""Every registered query against its SQL on the sample tables."""

import os

import pytest

import __spark_entry__ as entry_points
from feedloom.suite import ORACLES as SUITE_SQL
from feedloom.suite import QUERIES as SUITE
from tests.oracle import compare, sql_session

SF_DIR = os.environ.get("FEEDLOOM_SF_DIR", "/root/testdata/sf0.001")
QUERIES = SUITE
ORACLES = SUITE_SQL


@pytest.fixture(scope="module")
def con():
    return sql_session(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["path_id", "path_dscr"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    (kinds, rows), (sql_kinds, sql_rows) = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert kinds == sql_kinds
    assert rows - sql_rows == sql_rows - rows
    assert sum(rows.values()) > 0
