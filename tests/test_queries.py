"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, connect  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_names_match():
    assert set(entry.ORACLES) == set(entry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    good, note = compare(spark, con, FOLDER, name)
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
