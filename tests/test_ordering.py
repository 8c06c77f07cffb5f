"""Ordered operators against brute force, on data where one group or one value dominates."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratavault.operators import ordering as o


def chain(data, ahead):
    groups = defaultdict(list)
    for g, v in data:
        groups[g].append(v)
    found = []
    for g, members in groups.items():
        members.sort(key=lambda v: (v is not None, v))
        for i, v in enumerate(members):
            j = i + 1 if ahead else i - 1
            found.append((g, v, (members[j],) if 0 <= j < len(members) else None))
    return sorted(found, key=repr)


def as_pairs(df):
    return sorted(((r["g"], r["v"], None if r["n"] is None else tuple(r["n"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbours_with_dominant_group(spark, ahead):
    rng = random.Random(7)
    data = {("hot", rng.randrange(10_000)) for _ in range(3000)} | {(f"g{rng.randrange(40)}", rng.randrange(10_000)) for _ in range(3000)}
    data |= {(None, 5), (None, 9), ("hot", None)}
    df = spark.createDataFrame(sorted(data, key=repr), "g string, v bigint")
    assert as_pairs(o.with_neighbour(df, ["g"], ["v"], "n", ahead=ahead, slices=16)) == chain(data, ahead)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=40),
       st.booleans(), st.integers(2, 9))
def test_neighbours_any_data(spark, data, ahead, slices):
    df = spark.createDataFrame(list(data), "g string, v bigint")
    assert as_pairs(o.with_neighbour(df, ["g"], ["v"], "n", ahead=ahead, slices=slices)) == chain(data, ahead)


@pytest.mark.parametrize("ahead", [True, False])
def test_two_columns_with_one_dominant_start(spark, ahead):
    """A third of all rows: one group, one lower bound, many upper bounds."""
    rng = random.Random(3)
    data = {("hot", 50, u) for u in range(1500)} | {(f"g{rng.randrange(5)}", rng.randrange(100), rng.randrange(30)) for _ in range(3000)}
    data |= {("hot", None, 1), ("hot", 50, None), (None, 50, 7), ("hot", 49, 3), ("hot", 51, 0)}
    df = spark.createDataFrame(sorted(data, key=repr), "g string, lo bigint, hi bigint")
    got = o.with_neighbour(df, ["g"], ["lo", "hi"], "n", ahead=ahead, slices=8)
    found = sorted(((r["g"], (r["lo"], r["hi"]), None if r["n"] is None else (tuple(r["n"]),)) for r in got.collect()), key=repr)
    def rank(pair):
        return tuple((v is not None, v or 0) for v in pair)
    groups = defaultdict(list)
    for g, lo, hi in data:
        groups[g].append((lo, hi))
    expected = []
    for g, members in groups.items():
        members.sort(key=rank)
        for i, pair in enumerate(members):
            j = i + 1 if ahead else i - 1
            expected.append((g, pair, (members[j],) if 0 <= j < len(members) else None))
    assert found == sorted(expected, key=repr)
    sizes = o.with_slices(df, ["lo", "hi"], 8).groupBy("g", "_slice").count()
    assert sizes.agg({"count": "max"}).first()[0] < 1.5 * len(data) / 8  # an even share is len(data) / 8


@pytest.mark.parametrize("kind,make", [
    ("timestamp_ntz", lambda i: datetime(2024, 1, 1) + timedelta(seconds=i * 977)),
    ("string", lambda i: ("ю" if i % 3 else "a") + f"{i * 7919 % 1000:04d}"),
    ("double", lambda i: (i * 37 % 501) / 7 + i * 1e-6),
    ("decimal(10,2)", None),
])
def test_numbering_is_row_number(spark, kind, make):
    import decimal
    make = make or (lambda i: decimal.Decimal(i * 13 % 997) / 4)
    data = sorted({make(i) for i in range(900)}, key=lambda v: v.encode() if isinstance(v, str) else v)
    df = spark.createDataFrame([(v,) for v in reversed(data)], f"v {kind}")
    found = [r["v"] for r in o.numbered(df, "v", "no", slices=8).orderBy("no").collect()]
    assert found == data
    assert values(o.numbered(df, "v", "no", slices=8).select("no")) == sorted(range(1, len(data) + 1), key=repr)


def test_work_is_spread(spark):
    df = spark.range(10_000).selectExpr("'hot' AS g", "id AS v")
    sizes = o.with_slices(df, ["v"], 16).groupBy("_slice").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 1500


def test_copies_round_trip(spark):
    df = spark.range(35_000).selectExpr("CASE WHEN id < 30000 THEN 'x' WHEN id < 34999 THEN null ELSE 'z' END AS v")
    folded = o.distinct_with_counts(df, ["v"])
    assert folded.count() == 3
    back = o.expand_copies(folded)
    assert rows(back.groupBy("v").count()) == [("x", 30000), ("z", 1), (None, 4999)]


def test_common_prefixes_are_spread(spark):
    df = spark.range(10_000).selectExpr("concat('one long common prefix ', lpad(id, 6, '0')) AS v")
    sizes = o.with_slices(df, ["v"], 16).groupBy("_slice").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 1500


def test_slices_are_free(spark):
    with pytest.raises(ValueError):
        o.with_slices(spark.range(3), ["id"], slices=1)
    sizes = [r["count"] for r in o.with_slices(spark.range(20_000), ["id"], slices=1000).groupBy("_slice").count().collect()]
    assert len(sizes) > 950 and max(sizes) < 100


def test_very_many_copies_need_no_long_array(spark):
    frame = spark.sql("SELECT 'x' AS v, CAST(250000000 AS BIGINT) AS _copies")
    assert o.expand_copies(frame).count() == 250_000_000


def test_empty_input(spark):
    df = spark.sql("SELECT 'a' AS g, 1 AS v").limit(0)
    assert o.with_neighbour(df, ["g"], ["v"], "n").count() == 0 and o.numbered(df, "v", "no").count() == 0
