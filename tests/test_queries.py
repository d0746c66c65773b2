"""Every registered query against its SQL, on the smallest given tables."""

import inspect

import pytest

import __spark_entry__ as entry
from assaylake.session import pin_utc
from verification.compare import connect, differences
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    # the operators on text, if they are there, have tests of their own
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert list(inspect.signature(entry.entry).parameters) == ["spark"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry.entry(pin_utc(spark))
    assert df.columns[0] == "user_id" and df.count() > 0
