import random
from collections import Counter

import pytest

from stratavault.llm import decontaminate

ITEMS = "item_id bigint, text string"


def shingles(words, width):
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


def brute(docs, items, similarity=0.8):
    """Best window of each document and item over all starts."""
    out = {}
    for doc, text in docs:
        words = (text or "").lower().split()
        for item, passage in items:
            wanted = (passage or "").lower().split()
            width = min(5, len(wanted))
            if not wanted or len(words) < width:
                continue
            own, there = Counter(shingles(wanted, width)), shingles(words, width)
            n = sum(own.values())
            shown = min(n, len(there))
            best = max(sum((Counter(there[t:t + shown]) & own).values()) / (n + shown - sum((Counter(there[t:t + shown]) & own).values()))
                       for t in range(len(there) - shown + 1))
            if best >= similarity:
                out[doc, item] = max(best, out.get((doc, item), 0))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 40)))) for i in range(12)] + [(50, "one two"), (51, None), (52, ""), (53, "rep " * 20), (0, "other text of item zero again here")]
    rows = []
    for d in range(40):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        if d % 2:
            passage = items[rng.randrange(12)][1].split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(passage))
                passage[at:at + rng.randint(0, 1)] = ["odd"] * rng.randint(0, 2)
            words[len(words) // 2:len(words) // 2] = passage
        rows.append((d, " ".join(words)))
    rows += [(100, None), (101, ""), (102, items[3][1].upper().replace(" ", "\t\n ")), (103, " ".join(items[4][1].split()[:-1])), (104, "say one two again"),
             (105, "rep " * 300), (106, items[5][1] + " " + items[5][1]), (107, ("x y z " * 9000) + items[6][1])]
    return rows, items


def found(frame, spark, items, **options):
    rows = decontaminate.leaked_pairs(frame, spark.createDataFrame(items, ITEMS), **options).collect()
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


def test_against_brute_force_over_all_windows(spark, docs, clashing, corpus):
    rows, items = corpus
    expected = brute(rows, items)
    assert len(expected) >= 12
    assert found(clashing(docs(*rows, rows[1])), spark, items) == pytest.approx(expected)


def test_many_items_take_the_shuffle_join(spark, docs, corpus):
    rows, items = corpus
    assert found(docs(*rows), spark, items, broadcast_shingles=0) == pytest.approx(brute(rows, items))


@pytest.fixture(scope="module")
def repeating():
    """Items of few, often repeated shingles, whose fingerprints are full of ties, each with texts one word short or odd."""
    rng = random.Random(23)
    items, rows = [], []
    for i in range(300):
        period = [f"p{i}x{n}" for n in range(rng.randint(2, 6))]
        words = (period * 40)[:rng.randint(30, 60)]
        items.append((i, " ".join(words)))
        for _ in range(5):
            near, at = list(words), rng.randrange(len(words))
            near[at:at + rng.randint(0, 1)] = [f"odd{len(rows)}"] * rng.randint(0, 1)
            rows.append((len(rows), " ".join(near)))
    return rows, items


def test_items_of_repeated_shingles_lose_no_pair(spark, docs, repeating):
    rows, items = repeating
    by_id = dict(items)
    expected = {}
    for doc, text in rows:
        expected |= brute([(doc, text)], [(doc // 5, by_id[doc // 5])])
    assert len(expected) > 1000
    assert found(docs(*rows), spark, items) == pytest.approx(expected)


def test_certain_bits_hold_in_every_window_at_the_similarity(spark, repeating):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        own = [rng.getrandbits(64) - (1 << 63) for _ in range(rng.randint(1, 12))] * rng.randint(1, 6)
        window = list(own)
        for _ in range(rng.randint(0, 1 + len(own) // 8)):
            window[rng.randrange(len(window))] = rng.getrandbits(64) - (1 << 63)
        window = window[rng.randint(0, len(own) // 10):]
        shared = sum((Counter(own) & Counter(window)).values())
        if shared / (len(own) + len(window) - shared) >= 0.8:
            rows.append((own, window))
    frame = spark.createDataFrame(rows, "o array<bigint>, w array<bigint>")
    got = frame.select(decontaminate.simhash(frame["o"]).alias("o"), decontaminate.simhash(frame["w"]).alias("w"),
                       decontaminate.certain(frame["o"], 0.8).alias("c")).collect()
    assert len(got) > 100
    assert all((r.o ^ r.w) & r.c == 0 for r in got)
    assert sum(bin(r.c % (1 << 64)).count("1") for r in got) > len(got)


def test_start_of_the_best_window(spark, docs):
    item = " ".join(f"i{n}" for n in range(20))
    frame = docs((1, "a b c " + item + " d e"), (None, item))
    rows = decontaminate.leaked_pairs(frame, spark.createDataFrame([(None, item)], ITEMS)).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.similarity, r.start) for r in rows) == [(0, None, 1.0, 0), (1, None, 1.0, 3)]


def test_clean_documents_stay(spark, docs, clashing, corpus):
    rows, items = corpus
    frame = clashing(docs(*rows, rows[0]))
    kept = decontaminate.clean(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == frame.columns
    leaked = {d for d, _ in brute(rows, items)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in [*rows, rows[0]] if d not in leaked)


def test_empty_tables(spark, docs):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    assert decontaminate.leaked_pairs(docs((1, "a b c d e f")), none).collect() == []
    assert decontaminate.leaked_pairs(docs((1, "a")).where("false"), some).collect() == []


def test_fingerprint_is_the_majority_of_the_bits(spark):
    rng = random.Random(2)
    for size in (1, 2, 3, 40):
        hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(size)]
        frame = spark.createDataFrame([(hashes,)], "h array<bigint>")
        got = frame.select(decontaminate.simhash(frame["h"]).alias("f")).first()["f"] % (1 << 64)
        assert got == sum(1 << b for b in range(64) if 2 * sum(h % (1 << 64) >> b & 1 for h in hashes) > size)
