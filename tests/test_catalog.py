"""Every core query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from sheafline.plans import catalog

SLOW = {"train_eval", "crawl_bfs"}


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rounded(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, data, db, name):
    df = catalog.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(rounded(r[c]) for c in cols) for r in df.collect()), key=key)
    cur = db.execute(catalog.SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(rounded(r[i]) for i in at) for r in cur.fetchall()), key=key)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL) - SLOW))
def test_other_queries_run(spark, data, name):
    rows = catalog.QUERIES[name](spark, data).collect()
    assert rows and len(set(map(str, rows))) == len(rows)


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
