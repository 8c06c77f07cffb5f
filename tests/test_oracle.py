"""Every registered query against its SQL in DuckDB, whole tables of the smallest scale."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

from stratavault.catalog.registry import all_queries

DATA = Path("/root/testdata/sf0.001")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    if not DATA.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for file in sorted(DATA.glob("*.parquet")):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return f"decimal {v}" if isinstance(v, decimal.Decimal) else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    query = QUERIES[name]
    df = query.run(spark, str(DATA))
    expected = duck.sql(query.sql)
    assert sorted(df.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in df.columns]
    found = sorted(tuple(plain(v) for v in row) for row in df.collect())
    wanted = sorted(tuple(plain(row[i]) for i in order) for row in expected.fetchall())
    assert found == wanted


def test_views_go_with_the_query_that_made_them(spark):
    QUERIES["relations_by_pattern"].run(spark, str(DATA)).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stratavault_all_")]
