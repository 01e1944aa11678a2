"""Every registered query against its independent SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) == ""


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert "fraud_rate" in df.columns
    assert df.count() > 0
