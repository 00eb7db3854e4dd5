"""Every registered query against its SQL counterpart. SF_DIR selects the data."""

import os

import pytest
from oracle_check import differences, duckdb_tables

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(SF_DIR)


def test_every_query_has_sql_or_is_known_to_have_none():
    without = set(spark_entry.queries()) - set(spark_entry.oracle_sql())
    assert not {n for n in without if not n.startswith("op") and n != "pipeline"}


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query(spark, tables, name):
    result = spark_entry.queries()[name](spark, SF_DIR)
    assert differences(result, tables, spark_entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
