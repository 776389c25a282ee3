"""Every registered query against its SQL twin, and the contract of the entry module."""

import pytest

from compare import difference
from conftest import SF
from lakewarden.plans import oracles, queries


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_rows_as_sql(spark, duck, name):
    assert difference(spark, duck, name, SF) is None


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_have_sql():
    assert set(queries()) == set(oracles())
