"""Differential test: every registered query against its independent SQL twin."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from conftest import SF_SMALL

from adfuse.plans.catalog import QUERIES
from adfuse.plans.oracle import ORACLE



@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name], exact=True)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "platform", "spend", "conversions", "impressions", "clicks", "spend_7d_avg"]
    assert df.count() > 0
