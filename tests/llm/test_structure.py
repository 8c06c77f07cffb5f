import hashlib
import random
import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratavault.llm import queries, structure

BLANKS = " \t\n\x0b\x0c\r"
DATA = "/root/testdata/sf0.001"


def faults(rows):
    """rows in order -> fault of each"""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANKS)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit, turns) by trying all edits, at most two insertions in a row."""
    best = [(10 ** 9, "", [])]

    def go(at, cost, audit, turns, inserted):
        if (cost, audit) >= best[0][:2] and cost > best[0][0]:
            return
        initials = "".join(t[0][:1] or "-" for t in turns)
        if not re.fullmatch("(s?(ua)*u?)?", initials):
            return
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best[0] = min(best[0], (cost, audit, turns), key=lambda b: b[:2])
        if inserted < 2:
            for role in ("user", "assistant"):
                go(at, cost + 2, audit + "I", [*turns, (role, "")], inserted + 1)
        if at < len(rows):
            _, role, text = rows[at]
            go(at + 1, cost + 3, audit + "D", turns, 0)
            if found[at] not in ("blank", "duplicate"):
                more = found[at] == "truncated"
                go(at + 1, cost + more, audit + "K", [*turns, (role, text)], 0)
                for other in ("user", "assistant"):
                    go(at + 1, cost + 2 + more, audit + "R", [*turns, (other, text)], 0)
    go(0, 0, "", [], 0)
    return best[0]


def plain(rows):
    """rows of (turn, role, text) -> the report of one conversation"""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found, turns = faults(rows), {t for t, _, _ in rows if t is not None}
    pairs = [rows[i][1][:1] + rows[i + 1][1][:1] for i in range(len(rows) - 1)]
    cost, audit, kept = cheapest(rows, found)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def invented(seed, convs, most):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(convs)]:
        for i in range(rng.randint(0, most)):
            rows.append((conv, rng.choice([None, i, i, i, 2 * i]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "Yes.", "and", "", " \t", "ça va? ", "cut off", "é", None, "x" * 3000 + "."])))
    return rows + [r for r in rows if rng.random() < 0.1]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return made.withColumns({c: F.lit("x") for c in ("conv", "present", "has_turn", "earlier", "blank", "cut", "place")}).repartition(3)


@pytest.mark.parametrize("spill", [structure.SPILL_BYTES, 100])
def test_audits_and_turns_against_all_edits(spark, spill):
    rows = invented(6, 60, 5)
    found = {r.conv_id: tuple(r)[1:] for r in structure.audited(frame(spark, rows), spill_bytes=spill).collect()}
    convs = {c for c, *_ in rows}
    assert found == {c: plain([r[1:] for r in rows if r[0] == c]) for c in convs}
    turns = {}
    for r in structure.repaired(frame(spark, rows), spill_bytes=spill).orderBy("place").collect():
        turns.setdefault(r.conv_id, []).append(r)
    for c in convs:
        kept = "\n".join(f"{r.role}:{r.text}" for r in turns[c] if r.edit != "D")
        assert "".join(r.edit for r in turns[c]) == found[c][6] and hashlib.sha256(kept.encode()).hexdigest() == found[c][7]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns[c] if r.role is not None))


def test_giant_conversation_spills_and_agrees(spark, monkeypatch):
    n = 30_000
    rows = spark.range(n).select(F.lit(9).cast("bigint").alias("conv_id"), (F.col("id") * 2).alias("turn"),
                                 F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(" ok.")).alias("text"))
    found = structure.audited(rows, spill_bytes=10_000).first()
    assert (found.gaps, found.cost, found.audit) == (n - 1, 0, "K" * n)
    assert found.repaired_sha256 == hashlib.sha256("\n".join(f"{'assistant' if i % 2 else 'user'}:{i} ok." for i in range(n)).encode()).hexdigest()


def test_conversations_without_rows_and_an_empty_table(spark):
    rows = frame(spark, [(1, 0, "user", "a."), (2, 0, "user", "a."), (2, 1, "assistant", "b.")])
    found = {r.conv_id: tuple(r)[1:] for r in structure.audited(rows, F.col("conv_id") == 2).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert found == {1: (0, 0, 0, 0, 0, 0, "", nothing), 2: (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:a.\nassistant:b.").hexdigest())}
    assert structure.audited(rows.where("false")).collect() == structure.repaired(rows.where("false")).collect() == []


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_query_against_all_edits(spark):
    groups = {}
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect():
        kind = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        role, text = " " if r.role is None else r.role, " " if r.text is None else r.text
        rows = groups.setdefault(r.conv_id, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(r.turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {r.conv_id: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, DATA).collect()}
    assert found == {c: plain(rows) for c, rows in groups.items()}
