"""Registered queries over whole tables of the smallest scale, against SQL."""

from pathlib import Path

import duckdb
import pytest

from stratavault.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not DATA.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name].run(spark, str(DATA))
    expected = duck.sql(QUERIES[name].sql)
    assert sorted(df.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in df.columns]
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in expected.fetchall())


def test_there_is_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
