"""Rows told apart by bits of their names, with so few bits that names collide, and with many."""

import pytest

from stratavault.llm import base
from stratavault.session import materialise
from pyspark.sql import functions as F


@pytest.fixture(params=[1 << 27, 1 << 16, 8, 1])
def slots(request, monkeypatch):
    monkeypatch.setattr(base, "SLOTS", request.param)


@pytest.fixture
def frame(docs, clashing):
    rows = [(i, f"text {i % 40}") for i in range(200)] + [(7, "text 7")] * 5 + [(None, None), (None, None), (None, "a"), (500, None), (501, "")]
    return clashing(docs(*rows))


def named(frame):
    units = frame.withColumn("_mark", F.xxhash64("text")).groupBy("doc_id", "_mark").agg(F.count(F.lit(1)).alias("rows"))
    return units.withColumn("stays", F.coalesce(F.col("doc_id") % 3 == 1, F.lit(True)))


def found(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_only_one_row_of_each_name_that_stays(slots, frame):
    kept = base.only(frame, named(frame))
    assert kept.columns == frame.columns
    want = {(r.doc_id, r.text) for r in frame.collect() if r.doc_id is None or r.doc_id % 3 == 1}
    assert found(kept) == sorted(want, key=repr)


def test_without_leaves_out_all_rows_of_a_name(slots, frame):
    gone = materialise(frame.where("doc_id = 7 OR text IS NULL OR doc_id > 190").select(
        F.col("doc_id").alias("_k_id"), F.xxhash64("text").alias("_k_mark")).distinct(), "gone")
    kept = base.without(frame, gone)
    assert kept.columns == frame.columns
    want = [(r.doc_id, r.text) for r in frame.collect() if not (r.doc_id == 7 or r.text is None or (r.doc_id or 0) > 190)]
    assert found(kept) == sorted(want, key=repr)


def test_texts_of_named_rows(slots, frame):
    names = materialise(frame.where("doc_id IS NULL OR doc_id IN (7, 500)").select(
        F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_m"), F.lit("k").alias("key")).distinct(), "members")
    texts = base.texts_of(frame, names)
    assert set(texts.columns) == {"doc_id", "_mark", "_text", "key"}
    assert texts.groupBy("doc_id").count().orderBy(F.desc("count")).collect()[0]["count"] == 6
    assert texts.count() == 10


def test_empty_tables(slots, frame):
    assert base.only(frame.where("false"), named(frame.where("false"))).collect() == []
    gone = materialise(frame.where("false").select(F.col("doc_id").alias("_k_id"), F.xxhash64("text").alias("_k_mark")), "gone")
    assert base.without(frame, gone).count() == frame.count()


def test_the_mix_takes_the_same_rows_however_few_the_bits(docs, monkeypatch):
    from stratavault.llm import mixing
    frame = docs(*[(i, "w " * (i % 9 + 1), "a" if i % 4 else "b") for i in range(300)], *[(1000, "w w", "b")] * 30)
    want = sorted(tuple(r) for r in mixing.take(frame).collect())
    monkeypatch.setattr(base, "SLOTS", 4)
    assert sorted(tuple(r) for r in mixing.take(frame).collect()) == want and want


def test_a_table_of_names_grows_with_the_names():
    """What is broadcast for few names is small; that of many is bounded."""
    assert base.slots_for(0) == base.slots_for(2048) == 1 << 15
    assert base.slots_for(2049) == 1 << 16 and base.slots_for(1 << 20) == 1 << 24
    assert base.slots_for(1 << 23) == base.slots_for(1 << 40) == base.SLOTS == 1 << 27
