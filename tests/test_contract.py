"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.compare import difference, oracle

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    frame = entry.queries()[name](spark, SMALL)
    if name in SQL:
        assert difference(frame, connection, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["ingredients_id", "ingredients", "count"]
