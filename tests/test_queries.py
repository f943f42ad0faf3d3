"""Every registered query beside its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.compare import connect, difference

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    if name in SQL:
        assert difference(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 496
