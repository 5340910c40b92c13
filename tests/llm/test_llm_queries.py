"""Queries with an SQL form against it, at the smallest scale, to the bit."""

import pytest
from compare import compare, duck

from tagloom.llm.queries import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    good, note = compare(spark, duck(SF_DIR), SF_DIR, name, QUERIES[name], CHECKS[name])
    assert good, note


def test_all_are_registered():
    import __spark_entry__ as entry

    known = entry.queries()
    assert [sum(name.startswith(f"op{n}_") for name in known) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in known and set(CHECKS) <= set(entry.oracle_sql())
