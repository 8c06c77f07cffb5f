import random
import re

import numpy as np
import pytest
import xxhash

from stratavault.llm import simhash
from stratavault.llm.base import components


def plain_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance):
    """fps: {id: fingerprint} -> {id: smallest id reachable}"""
    ids, root = sorted(fps), {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "A b", "a B c", "ÀB ÉÉ   x y z", "The The The The", "w " * 100_000, "a\x1cb c\x85d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_near_duplicates_against_brute_force(docs, clashing):
    rng = random.Random(3)
    texts = [None, "", "one", "one", "two words"] + [" ".join(rng.choices("abcdefgh", k=rng.randint(4, 60))) for _ in range(30)]
    for t in texts[5:15]:
        words = t.split() * 6
        texts += [" ".join(words), " ".join(words[:-1] + ["z"]), " ".join(["Z"] + words[1:])]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = simhash.near_duplicates(clashing(docs(*rows, rows[7])))
    fps = {i: plain_fingerprint(t) for i, t in rows}
    roots = plain_components(fps, 2)
    expected = sorted([(i, f"{fps[i]:016x}", roots[i]) for i in fps] + [(7, f"{fps[7]:016x}", roots[7])])
    assert sorted(map(tuple, found.collect())) == expected


def linked(spark, fps, distance=2, bucket=simhash.BUCKET, masks=None):
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    found = components(simhash.link(nodes, masks or simhash.plan(nodes, distance), distance, bucket))
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in found.collect()}
    groups = {}
    for f in fps:
        groups.setdefault(roots.get(f, f), set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_dense_cluster_is_split_and_loses_nothing(spark):
    """A ball of radius two with more members than a bucket takes, beside chains and strangers."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    ball = {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(0, 64, 3)}
    chain, f = set(), rng.getrandbits(64)
    for b in range(0, 40, 2):
        chain.add(f)
        f ^= 3 << b
    fps = sorted(ball | chain | {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1, 3, 7})
    roots = plain_components({i: f for i, f in enumerate(fps)}, 2)
    groups = {}
    for i, r in roots.items():
        groups.setdefault(r, []).append(fps[i])
    assert linked(spark, fps) == sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_masks_cover_every_pair(spark, distance):
    rng = np.random.default_rng(7)
    nodes = spark.createDataFrame([(int(x),) for x in rng.integers(-(1 << 62), 1 << 62, 50)], "fp bigint")
    masks = simhash.plan(nodes, distance)
    for _ in range(300):
        apart = sum(1 << int(b) for b in rng.choice(64, distance, replace=False))
        assert any(not apart & m for m in masks)
        held = next(m for m in masks if not apart & m)
        while bin(held).count("1") < 56:
            held = next(m for m in simhash._split(held, distance) if not apart & m)


def test_thresholds_follow_the_costs():
    assert simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 7, 8]], 0) == (7.0, [0, 1, -1])
    assert simhash.allocate([[0, 1, 1], [0, 10, 10]], 0)[1] == [1, -1]


def test_one_document_of_each_component_stays(docs, clashing):
    base = " ".join(f"w{i}" for i in range(200))
    frame = clashing(docs((5, base), (3, base), (9, base + " x"), (4, "other text here"), (4, "other text here"), (None, base), (7, None)))
    kept = simhash.deduplicated(frame)
    assert kept.columns == frame.columns
    roots = plain_components({3: plain_fingerprint(base), 9: plain_fingerprint(base + " x"), 4: plain_fingerprint("other text here"), 7: 0}, 2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


def test_empty_table(docs):
    frame = docs((1, "a")).where("false")
    assert simhash.near_duplicates(frame).collect() == [] and simhash.deduplicated(frame).collect() == []


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (70, 60)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**dict.fromkeys([*range(61), 70], 0), **dict.fromkeys(range(1000, 1300), 1000)}
