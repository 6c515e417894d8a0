"""Every registered query against its DuckDB statement on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

from stakefold.queries import jobs, operators

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, SQL = {**operators.QUERIES, **jobs.QUERIES}, {**operators.ORACLES, **jobs.ORACLES}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in data)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cur = duck.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    want, got = bag(columns, cur.fetchall()), bag(df.columns, df.collect())
    assert got == want
    assert want, "a statement without rows checks nothing"


def test_invoices_hold_every_sales_type(spark):
    kinds = {r[0] for r in QUERIES["location_invoice"](spark, "/root/testdata/sf0.01").select("sales_type").distinct().collect()}
    assert kinds >= set("1 2 3 4 61 6 7 16 52 25 40 59 60 69 70 105 108 110 112 116 119 571 572 727".split())
    assert not kinds & {"-2", "-3"}
