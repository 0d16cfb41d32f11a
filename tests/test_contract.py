"""The driver contract of __spark_entry__: keys, DataFrames, column names."""

import re

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry
from compare import duck
from conftest import SF_SMALL

from adfuse.plans.catalog import QUERIES
from adfuse.plans.oracle import ORACLE

PLAIN = re.compile(r"^[a-z_][a-z0-9_]*$")


def test_keys_match():
    assert QUERIES and set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_columns_are_plain_and_match_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert isinstance(df, DataFrame)
    cols = df.columns
    assert len(cols) == len(set(cols)), cols
    assert all(PLAIN.match(c) for c in cols), cols
    sql_cols = con.sql(f"SELECT * FROM ({ORACLE[name]}) AS q LIMIT 0").columns
    assert sorted(cols) == sorted(sql_cols)
