import hashlib
import re

import pytest

from stratavault.llm import exact_dedup

ROWS = [(1, "a b"), (2, "ab"), (3, "a\tb \n"), (4, "a\tb \r"), (5, None), (6, ""), (7, " \x0b\x0c"), (8, "a\u00a0b"), (9, "long " * 3000), (10, "long" * 3000),
        (11, "long" * 3000 + "x"), (None, "a  b"), (None, "null id"), (12, "rep"), (12, "rep"), (13, "é😀" * 50), (14, "é 😀" * 50)]


def expected(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for norm, members in groups.items():
        members.sort()
        out += [(m[3], members[0][3], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()) for i, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"chunk": 100, "compare": 16}, {"chunk": 100, "primes": (7, 5)}, {"primes": (2, 2)}])
def test_against_brute_force(docs, clashing, options):
    """Also with short chunks, and with moduli so small that different texts collide."""
    found = exact_dedup.duplicates(clashing(docs(*ROWS)), **options)
    assert sorted((tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr) == expected(ROWS)


def test_collisions_of_equal_length_are_split(docs):
    rows = [(i, f"{i:04d}") for i in range(0, 120, 9)] + [(i + 200, f"{i:02d} {i:02d}") for i in range(6)] + [(i + 300, f"{i:02d}{i:02d}") for i in range(6)]
    found = exact_dedup.duplicates(docs(*rows), primes=(3, 2))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_chunk_fingerprints_combine(spark, docs):
    text = "The quick\tbrown é fox " * 400
    keys = {exact_dedup.fingerprinted(docs((1, text)), chunk=c).first()["key"] for c in (7, 64, 1000, 1 << 20)}
    assert len(keys) == 1


def test_rows_that_stay(docs, clashing):
    frame = clashing(docs(*ROWS))
    kept = exact_dedup.deduplicated(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        (doc or 0, text) for doc, text in [(3, "a\tb \n"), (7, " \x0b\x0c"), (8, "a\u00a0b"), (9, "long " * 3000), (11, "long" * 3000 + "x"), (None, "null id"), (12, "rep"),
                                           (14, "é 😀" * 50)])


def test_empty_table(docs):
    frame = docs((1, "a")).where("false")
    assert exact_dedup.duplicates(frame).collect() == [] and exact_dedup.deduplicated(frame).collect() == []
