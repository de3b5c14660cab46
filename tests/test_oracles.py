"""Every registered query that has SQL gives what DuckDB makes of it, and changes something."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if not n.startswith("op")])
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    at = [want.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr) and rows
