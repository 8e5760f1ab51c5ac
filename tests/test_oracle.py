"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


def test_every_query_has_sql():
    """All but those of the optional subpackage, which has tests of its own."""
    assert not set(SQL) - set(QUERIES)
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(QUERIES) - set(SQL))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "report_month" and df.count() > 0


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, tiny, name):
    assert compare(QUERIES[name](spark, tiny), duck, SQL[name]) is None
