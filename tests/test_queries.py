"""Every registered query of the base library against DuckDB on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from locusweave.queries import registered

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = registered()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DIR)
    rows = sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)
    if name not in SQL:
        assert rows
        return
    found = db.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert rows == sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
