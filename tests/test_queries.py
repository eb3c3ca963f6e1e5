"""Every registered query against its SQL on the smallest tables."""

import pytest

from kontora.queries import catalog
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(catalog.queries()[name](spark, FOLDER), con, SQL[name]) in ("", "~")


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
