import numpy as np
import pytest

from stratavault.llm import base, quality, secrets, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def test_an_id_counts_once(spark, docs):
    frame = docs(*[(1, "same")] * 200, *[(2, f"t{i}") for i in range(100)], (3, "c"), (None, "x"), (4, None))
    names = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (4, 0), (9, 1)], "_d bigint, _y int")
    found = sorted((r["_d"], r["_y"], r["_t"]) for r in base.sampled(frame, names).collect())
    assert [f[:2] for f in found] == [(1, 0), (1, 1), (2, 1), (4, 0)] and found[0][2] == found[1][2] == "same" and found[3][2] is None
    assert sorted((r["_d"], r["_y"], r["_t"]) for r in base.sampled(frame.repartition(7), names).collect()) == found


@pytest.fixture
def tables(spark, docs):
    """Labelled documents, once plain and once with one of them in 300 copies."""
    rows = [(i, "\n".join([f"alpha beta{i % 7} " + ("vile" if i % 2 else "kind") + (" ###" if i % 3 else ".")] * (1 + i % 4)) + " key 0123456789abcdef") for i in range(120)]
    hot = next(i for i in range(120) if not spark.range(i, i + 1).where(quality.held_out(base.F.col("id"))).count())
    labels = spark.createDataFrame([(i, int(i % 3 == 0), i % 2) for i in range(120)], LABELS)
    return docs(*rows), docs(*rows, *[rows[hot]] * 300), labels


def test_copies_do_not_outweigh_the_rest(tables):
    plain, copied, labels = tables
    a, b = (quality.train(t, labels) for t in (plain, copied))
    assert np.allclose(a.weights, b.weights) and np.allclose(a.mean, b.mean)
    a, b = (toxicity.train(t, labels) for t in (plain, copied))
    assert a.places == b.places and all(np.allclose(x, y) for x, y in zip(a.weights, b.weights, strict=True))


def test_copies_reach_the_driver_once(tables, monkeypatch):
    seen = []
    monkeypatch.setattr(secrets, "train", lambda windows, labels, *_, **__: seen.append(len(labels)))
    for table in tables[:2]:
        secrets.network(table)
    assert seen[0] == seen[1] > 120
