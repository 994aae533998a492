"""Every registered query against its SQL statement on the smallest tables."""

import pytest
from check import connect, difference
from small_tables import FOLDER

import __spark_entry__ as entry
from freightlens import registry

STATEMENTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert sorted(registry.QUERIES) == sorted(n for n in STATEMENTS if n in registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, duck):
    assert difference(entry.queries()[name](spark, FOLDER), duck, STATEMENTS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
