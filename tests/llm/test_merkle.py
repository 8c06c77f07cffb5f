import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stratavault.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests, fanout):
    """Root, and per leaf the siblings in order as (place, others)."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for leaf, node in enumerate(at):
            first = node - node % fanout
            run = level[first:first + fanout]
            paths[leaf].append((node % fanout, run[:node % fanout] + run[node % fanout + 1:]))
        level = [H(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [n // fanout for n in at]
    return level[0], paths


def plain(rows, fanout):
    """rows of (doc_id, lang, leaf) -> sorted (doc_id, lang, leaf, subroot, root, siblings)."""
    groups = {}
    for d, g, h in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(g, []).append((d, h))
    grown = [tree([h for _, h in members], fanout) for members in groups.values()]
    root, above = tree([r for r, _ in grown], fanout)
    out = []
    for (g, members), (subroot, paths), top in zip(groups.items(), grown, above, strict=True):
        for (d, h), path in zip(members, paths, strict=True):
            out.append((d, g, h, subroot, root, "".join("".join(others) for _, others in path + top)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout, run, spread", [(2, 256, 256), (2, 2, 2), (3, 9, 4), (16, 16, 256)])
def test_proofs_against_plain_trees(spark, monkeypatch, fanout, run, spread):
    monkeypatch.setattr(merkle, "SPREAD", spread)
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(150)]), rng.choice([None, "", "a", "a", "a", "é", "z-"])) for _ in range(220)] + [(7, "one")] + [(3, "a")] * 40
    rows = [(d, g, H(str(d), str(rng.randint(0, 2)))) for d, g in rows]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, leaf string").withColumns({c: F.lit(1) for c in ("extra", "n", "at", "key")}).repartition(3)
    found = merkle.manifest(frame, "lang", "doc_id", fanout, run)
    assert found.columns[:3] == ["doc_id", "lang", "extra"]
    got = found.withColumn("ok", merkle.folded(F.col("leaf"), F.col("steps"), F.col("siblings")) == F.col("root")).collect()
    assert all(r.ok for r in got)
    assert sorted(((r.doc_id, r.lang, r.leaf, r.subroot, r.root, bytes(r.siblings).hex()) for r in got), key=repr) == plain(rows, fanout)


def test_one_changed_leaf_is_found(spark):
    rows = [(i, "en" if i % 3 else None, H(str(i))) for i in range(70)]
    found = merkle.manifest(spark.createDataFrame(rows, "doc_id bigint, lang string, leaf string"), "lang", "doc_id")
    shown = F.when(F.col("doc_id") == 11, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf"))
    wrong = found.where(merkle.folded(shown, F.col("steps"), F.col("siblings")) != F.col("root"))
    assert [r.doc_id for r in wrong.collect()] == [11]


def test_one_leaf_and_none(spark):
    one = spark.createDataFrame([(1, "en", H("x"))], "doc_id bigint, lang string, leaf string")
    row = merkle.manifest(one, "lang", "doc_id").withColumn("proof", merkle.proof_digest(F.col("siblings"))).first()
    assert (row.subroot, row.root, row.proof, row.steps) == (H("x"), H("x"), H(""), "")
    assert merkle.manifest(one.where("false"), "lang", "doc_id").collect() == []


def test_leaf_values(spark):
    frame = spark.sql("SELECT * FROM VALUES (1, 'é', CAST(NULL AS STRING), ''), (CAST(NULL AS INT), 'a:b', '-', 'x') t(a, b, c, d)")
    found = [r[0] for r in frame.select(merkle.leaf([F.col(c) for c in frame.columns])).collect()]
    assert found == [H("1:12:é-0:"), H("-3:a:b1:-1:x")]
