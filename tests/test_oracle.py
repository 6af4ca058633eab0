"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import check, connect
from tagloom.plans.queries import QUERIES

SF_DIR = os.environ.get("TAGLOOM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
# Several trainings each; their parts have tests of their own, and the whole grid runs in test_sampling.
SLOW = {"vector_grid", "vector_checks", "held_out_likelihood"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, name):
    problem, rows, *_ = check(spark, duck, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["class", "row_kind", "count", "tp", "fp", "fn", "precision", "recall", "f1"]


def test_all_queries_have_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())
