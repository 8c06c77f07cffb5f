import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stratavault.llm import mixing


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by literal resharing; ``sizes`` is a dict of source sizes."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {}, Fraction(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in target]
        rest = total - sum(target.values())
        part = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        above = [s for s in free if part[s] > most * sizes[s]]
        if not above:
            return target | part
        target |= {s: Fraction(most * sizes[s]) for s in above}


@pytest.fixture
def many(docs):
    rng = random.Random(4)
    made = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), rng.choice(["a"] * 6 + ["b", "c", "é", "Z", None])) for i in range(1500)]
    return made, docs(*made)


def test_targets_words_and_bounds(many):
    made, frame = many
    rows = mixing.mixed(frame, block=16).collect()
    source = {i: s for i, _, s in made}
    sizes = {s: sum(len(t.split()) for _, t, x in made if x == s) for s in {s for _, _, s in made}}
    wanted = shares(sizes)
    assert len(rows) == len(made)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - float(wanted[s])) < 1e-6
        assert r.taken in {r["size"] * k for k in range(4)}
        taken[s] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= 41 for s in sizes)  # the last document of a source at most
    again = {r.doc_id: r.taken for r in mixing.mixed(frame.repartition(7), block=16, most_sources=0).collect()}  # the shuffle join
    assert again == {r.doc_id: r.taken for r in rows}


def test_expectation_holds_over_seeds(docs):
    frame = docs(*[(i, "w " * (i % 7 + 1), "a" if i % 3 else "b") for i in range(600)]).cache()
    total = {}
    for seed in range(5):
        for r in mixing.mixed(frame, seed=seed, block=4).collect():
            total[r.doc_id] = total.get(r.doc_id, 0) + r.taken / r["size"] * r.source_size / r.target
    assert abs(sum(total.values()) / len(total) / 5 - 1) < 0.05


def test_nulls_blank_texts_repeats_and_extra_columns(docs, clashing):
    frame = clashing(docs((1, None, "a"), (2, " \t", "a"), (3, "x y", None), (3, "x y", None), (None, "z", "b"), (4, "z " * 5000, "a")))
    rows = sorted((r.doc_id or 0, r["size"], r.taken % max(1, r["size"])) for r in mixing.mixed(frame).collect())
    assert rows == [(0, 1, 0), (1, 0, 0), (2, 0, 0), (3, 2, 0), (3, 2, 0), (4, 5000, 0)]
    kept = mixing.take(frame)
    assert set(kept.columns) == set(frame.columns) | {"copies"}
    assert kept.where("doc_id IN (1, 2)").isEmpty() and kept.where(F.col("copies") > 3).isEmpty()


def test_empty_table(docs):
    frame = docs((1, "a")).where("false")
    assert mixing.mixed(frame).collect() == [] and mixing.take(frame).collect() == []


@pytest.mark.parametrize("share", [3, 2])
def test_a_row_that_repeats_is_spread_over_its_copies(docs, share):
    """A third and two thirds of all words in one row that repeats: the target is met within one copy of a document."""
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(1, 60), "a") for i in range(400)]
    words = sum(len(t.split()) for _, t, _ in rows)
    rows += [(1000, "w " * 50, "a")] * (words // 50 * (share - 1) // (1 if share == 3 else 2) + 1)
    rows += [(2000 + i, "w " * 40, "b") for i in range(len(rows) // 3)]
    frame = docs(*rows, partitions=5)
    found = mixing.mixed(frame).collect()
    assert len(found) == len(rows)
    for source in ("a", "b"):
        mine = [r for r in found if (r.doc_id >= 2000) == (source == "b")]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 61 and all(r.taken <= 3 * r["size"] for r in mine)
    again = mixing.mixed(frame.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    read = mixing.take(frame).collect()
    assert sum(r.copies * len(r.text.split()) for r in read) == sum(r.taken for r in found)
    repeats = [r.copies for r in read if r.doc_id == 1000]
    assert not repeats or max(repeats) - min(repeats) <= 1
