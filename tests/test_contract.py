"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from filingweave.plans import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

QUERIES = {name: fn for name, fn in contract.queries().items() if name in all_queries()[0]}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for f in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    got = [r.asDict() for r in df.collect()]
    assert got, "no rows"
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    want = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert sorted(df.columns) == sorted(names)

    def ordered(rows):
        return sorted(repr([plain(r[c]) for c in sorted(names)]) for r in rows)

    assert ordered(got) == ordered(want)


def test_sql_for_every_query():
    assert SQL.keys() == QUERIES.keys()


@pytest.mark.parametrize(
    "name, column", [("summary_left_join", "report_type"), ("selected_reports", "report_type")]
)
def test_joins_have_hits_and_misses(spark, name, column):
    missing = QUERIES[name](spark, FOLDER).where(f"{column} = '정보없음'").count()
    assert 0 < missing < 150


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["company_id", "company", "report_type", "rcept_no"] and df.count() == 150
