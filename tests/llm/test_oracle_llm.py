"""Queries against their DuckDB SQL on the small tables."""

import duckdb
import pytest

from adfuse.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    rows = [tuple(plain(v) for v in r) for r in got.select(*names).collect()]
    assert sorted(rows, key=str) == sorted([tuple(plain(v) for v in r) for r in want], key=str)
    assert rows
