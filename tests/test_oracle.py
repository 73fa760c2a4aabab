"""Every registered query with an SQL twin, run on whole tables by both engines."""

import os

import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    result = entry.queries()[name](spark, FOLDER)
    assert compare.difference(result, con, entry.oracle_sql()[name]) is None


def test_entry_has_one_row_per_hour(spark):
    assert entry.entry(spark).count() == 24


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
