"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
from tagloom.plans.catalog import QUERIES  # noqa: E402
from tagloom.plans.checks import CHECKS  # noqa: E402


@pytest.fixture(scope="module")
def engine():
    return duck(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    good, note = compare(spark, engine, SF_DIR, name, QUERIES[name], CHECKS[name])
    assert good, note


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 12 * len({r.workbook for r in rows}) > 0
