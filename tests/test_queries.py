"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as registered
import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(registered.ORACLE)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    fn, sql = registered.queries()[name], registered.oracle_sql()[name]
    assert oracle.differences(spark, tables, SF_DIR, fn, sql) == []


def test_entry(spark):
    assert registered.entry(spark).count() > 0
