import random
import zlib
from itertools import product
from pathlib import Path

import numpy as np
import pytest

from stratavault.llm import quality

LABELS = "doc_id bigint, quality int, toxic int"
DATA = Path("/root/testdata/sf0.01")


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    lines, moves = np.array([1, 4, 0, 3]), rng.normal(size=(2, 2))
    scores = rng.normal(size=8)
    good, pairs = quality.marginals(scores, lines, moves)
    expected, together, at = [], np.zeros((2, 2)), 0
    for n in lines:
        own = scores[at:at + n]
        paths = list(product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(s for s, y in zip(own, p, strict=True) if y) + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths])
        weight /= weight.sum()
        expected += [sum(w for w, p in zip(weight, paths, strict=True) if p[t]) for t in range(n)]
        for w, p in zip(weight, paths, strict=True):
            for a, b in zip(p, p[1:], strict=False):
                together[a, b] += w
        at += n
    assert np.allclose(good, expected) and np.allclose(pairs, together)


@pytest.mark.parametrize("piece", [16, 1 << 21])
def test_line_sums(monkeypatch, piece):
    monkeypatch.setattr(quality, "PIECE", piece)
    own, size, lines = quality.line_features(["the the cat.\n\nA | b 12", None, "é" * 50])
    assert lines.tolist() == [3, 1, 1] and size.tolist() == [12, 0, 8, 0, 100]
    names = quality._CLASSES
    assert own[0, names.index("letter")] == 9 / 13 and own[0, len(names)] == 1 / 3  # one word equals the one before
    assert own[2, names.index("bar")] == 1 / 9 and own[2, names.index("digit")] == 2 / 9 and own[1, -1] == 1


def test_neighbours_stay_inside_a_text():
    own = np.arange(1.0, 5.0)[:, None]
    wide = quality.with_neighbours(own, np.array([2, 0, 2]))
    assert wide.tolist() == [[1, 0, 2, 1], [2, 1, 0, 1], [3, 0, 4, 1], [4, 3, 0, 1]]


@pytest.fixture
def labelled(spark, docs):
    rng = random.Random(6)

    def text(good):
        return "\n".join(" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=8)) + "." if good else "word### " * 8 for _ in range(rng.randint(1, 6)))
    rows = [(i, text(i % 3 > 0)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "x " * 200_000), (None, "word### word###"), (0, rows[0][1])]
    return docs(*rows), spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)] + [(None, 1, 0), (3, None, 0), (9999, 1, 0)], LABELS)


def test_labels_are_learnt_and_edge_cases_scored(labelled, clashing):
    frame, labels = labelled
    found = quality.judged(clashing(frame), labels).collect()
    assert len(found) == 155 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in found if r.doc_id is not None and r.doc_id < 150]) > 0.98
    kept = quality.good_only(clashing(frame), labels)
    assert kept.columns == clashing(frame).columns and kept.count() == sum(r.predicted for r in found)


def test_held_out_labels_change_nothing(labelled, spark):
    frame, labels = labelled
    flipped = labels.select("doc_id", (1 - labels["quality"]).alias("quality"), "toxic").where(quality.held_out(labels["doc_id"]))
    first = sorted((r.doc_id or -1, r.score) for r in quality.judged(frame, labels).collect())
    second = sorted((r.doc_id or -1, r.score) for r in quality.judged(frame, labels.where(~quality.held_out(labels["doc_id"])).unionByName(flipped)).collect())
    assert first == second


def test_no_labels_and_no_rows(labelled, spark, docs):
    frame, labels = labelled
    assert {r.score for r in quality.judged(frame, labels.where("false")).collect()} == {0.5}
    assert quality.judged(frame.where("false"), labels).collect() == []


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_held_out_accuracy(spark):
    from stratavault.llm.queries import op8_quality
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = op8_quality(spark, str(DATA)).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
