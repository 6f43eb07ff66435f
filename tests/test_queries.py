"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from forgeline import catalog

from compare import compare, connect
from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL, catalog.queries()[name], catalog.oracle_sql().get(name)) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
