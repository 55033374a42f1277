"""Every registered query against its reference SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle_compare import compare, connect
from orderloom import registry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_reference_sql():
    assert set(registry.ALL) <= set(entry.queries())
    assert set(registry.ALL) <= set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", registry.ALL)
def test_query_equals_reference_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, entry.queries()[name], ORACLES[name]) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
