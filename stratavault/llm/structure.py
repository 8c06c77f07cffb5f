"""Repair of the turn structure of conversations.

Rows are dealt out by conversation and sorted by turn, last turn first; one pass over the sorted stream carries the state
of a dynamic programme from one Arrow batch to the next: for each state of the pattern ``(s?(ua)+)?`` (start, behind a
system, user or assistant turn) the least cost of the turns that follow. Of each row only its text and one byte stay behind,
with the first edit of the cheapest repair from each state (of equal costs the one with the least letter); they are written to
a temporary file of the task once they pass a bound. At the first turn of a conversation the bytes are read back in order
of turns, which gives the edits and the repaired turns one by one. So memory is bounded for a conversation of any length.

Whether role and text were seen at an earlier turn is found before, by the first turn of each role and text (summed
map-side), in a salted join.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import salted_join, small_batches

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind an inserted or rerolled turn, and behind a kept one by its initial.
FORCED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {START: {SYSTEM: SYSTEM, USER: USER}, SYSTEM: {USER: USER}, USER: {ASSISTANT: ASSISTANT}, ASSISTANT: {USER: USER}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Edits in the order of their letters, and what they cost; a cut-off turn that stays costs one more.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
CUT_STAYS = 1
#: Costs behind the last turn: a system turn lacks two turns, a user turn one.
AT_END = (0, 4, 2, 0)
#: Bytes of turns kept in memory before they are written to the temporary file.
SPILL_BYTES = 8 << 20
_NEVER = 1 << 60
_BLANKS = " \t\n\x0b\x0c\r"
STREAM = ("conv", "present", "has_turn", "turn", "role", "text", "earlier", "blank", "cut")
REPORT = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "conv string, place bigint, edit string, role string, text string"


def step(after: tuple[int, ...], initial: int, gone: bool, cut: bool) -> tuple[tuple[int, ...], int]:
    """Costs from each state before a turn, given those behind it, and the first edits, two bits for each state."""
    stays = CUT_STAYS if cut else 0
    found = []
    for state in range(4):
        kept = KEPT[state].get(initial)
        found.append([COST[DELETE] + after[state], _NEVER,
                      _NEVER if gone or kept is None else COST[KEEP] + stays + after[kept],
                      _NEVER if gone else COST[REROLE] + stays + after[FORCED[state]]])
    costs = [min(f) for f in found]
    for _ in range(3):  # an inserted turn leads to another state at the same place
        costs = [min(c, COST[INSERT] + costs[FORCED[s]]) for s, c in enumerate(costs)]
    first = 0
    for state in range(4):
        found[state][INSERT] = COST[INSERT] + costs[FORCED[state]]
        first |= found[state].index(costs[state]) << 2 * state
    return tuple(costs), first


class Backlog:
    """Turns with their edit bytes, last turn first; read from the first turn on. Beyond a bound it goes to a file that
    is deleted with the task."""

    def __init__(self, most: int):
        self.most, self.file = most, None
        self.clear()

    def clear(self) -> None:
        self.rows, self.size, self.blocks = [], 0, []
        if self.file:
            self.file.close()
        self.file = None

    def add(self, edits: int, role: str, text: str) -> None:
        self.rows.append((edits, role, text))
        self.size += len(text) + 64
        if self.size > self.most:
            self.file = self.file or tempfile.TemporaryFile()
            data = pickle.dumps(self.rows)
            self.blocks.append((self.file.seek(0, 2), len(data)))
            self.file.write(data)
            self.rows, self.size = [], 0

    def forward(self) -> Iterator[tuple[int, str, str]]:
        yield from reversed(self.rows)
        for at, length in reversed(self.blocks):
            self.file.seek(at)
            yield from reversed(pickle.loads(self.file.read(length)))


class Conversation:
    """One conversation, taken turn by turn from its end."""

    def __init__(self, conv: str, most: int, known: dict):
        self.conv, self.known, self.backlog = conv, known, Backlog(most)
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.costs, self.total, self.illegal = AT_END, 0, 0
        self.high = self.low = self.later = self.waiting = None
        self.turns = 0

    def take(self, row) -> None:
        if row.has_turn:
            self.high = row.turn if self.high is None else self.high
            self.turns += row.turn != self.low
            self.low = row.turn
        if self.waiting is not None:
            last = self.waiting
            self._decide(last, last.earlier or (last.has_turn, last.turn, last.role, last.text) == (row.has_turn, row.turn, row.role, row.text))
        self.waiting = row

    def _decide(self, row, seen: bool) -> None:
        fault = "blank" if row.blank else "duplicate" if seen else "truncated" if row.cut else None
        if fault:
            self.counts[fault] += 1
        initial = INITIALS.get(row.role[:1], START)
        self.illegal += self.later is not None and (initial, self.later) not in LEGAL
        self.later = initial
        # few cost vectors occur once the least of each is taken off
        key = (self.costs, initial, fault in ("blank", "duplicate"), fault == "truncated")
        if key not in self.known:
            costs, first = step(*key)
            least = min(costs)
            self.known[key] = tuple(c - least for c in costs), least, first
        self.costs, least, first = self.known[key]
        self.total += least
        self.backlog.add(first, row.role, row.text)

    def finish(self) -> None:
        if self.waiting is not None:
            self._decide(self.waiting, self.waiting.earlier)
        self.waiting = None

    def edits(self) -> Iterator[tuple[str, str | None, str | None]]:
        """Edit letter, role and text of each edit, in order; role and text are those of the repaired turn, null for a deleted one."""
        state = START
        for first, role, text in self.backlog.forward():
            while (edit := first >> 2 * state & 3) == INSERT:
                state = FORCED[state]
                yield EDITS[INSERT], ROLES[state], ""
            if edit == DELETE:
                yield EDITS[DELETE], None, None
            elif edit == KEEP:
                state = KEPT[state][INITIALS[role[:1]]]
                yield EDITS[KEEP], role, text
            else:
                state = FORCED[state]
                yield EDITS[REROLE], ROLES[state], text
        while state in (SYSTEM, USER):
            state = FORCED[state]
            yield EDITS[INSERT], ROLES[state], ""

    def report(self) -> tuple:
        audit, digest, first = [], hashlib.sha256(), True
        for edit, role, text in self.edits():
            audit.append(edit)
            if role is not None:
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), self.illegal, self.total + self.costs[START], "".join(audit), digest.hexdigest())


def _conversations(batches: Iterator[pd.DataFrame], most: int) -> Iterator[Conversation | None]:
    """The conversations of a sorted stream, each complete; None behind every batch."""
    current, known = None, {}
    for batch in batches:
        for row in batch.itertuples(index=False):
            if current is None or row.conv != current.conv:
                if current is not None:
                    current.finish()
                    yield current
                    current.backlog.clear()
                current = Conversation(row.conv, most, known)
            if row.present:
                current.take(row)
        yield None
    if current is not None:
        current.finish()
        yield current
        current.backlog.clear()


def _reports(most: int):
    def reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows = [f.split()[0] for f in REPORT.split(", ")], []
        for found in _conversations(batches, most):
            if found is not None:
                rows.append(found.report())
            elif rows:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)
    return reports


def _turns(most: int):
    def turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows, size = [f.split()[0] for f in TURNS.split(", ")], [], 0
        for found in _conversations(batches, most):
            for place, (edit, role, text) in enumerate(found.edits() if found is not None else (), 1):
                rows.append((found.conv, place, edit, role, text))
                size += len(text or "") + 64
                if size > most:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)
    return turns


def _stream(conversations: DataFrame, present: Column | None) -> DataFrame:
    """The rows of all conversations, dealt out by conversation, each sorted from its last turn to its first."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = small_batches(conversations).select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("conv"),
        (F.lit(True) if present is None else present).alias("present"), F.col("turn").cast("bigint").alias("_turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"role": F.when(F.col("present"), F.col("role")).otherwise(""), "text": F.when(F.col("present"), F.col("text")).otherwise("")})
    said = rows.withColumn("_said", F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))))
    # of each role and text that a conversation has at several turns the first turn
    firsts = said.where("present").groupBy("conv", "_said").agg(
        F.min("_turn").alias("_first"), F.max("_turn").alias("_last"), F.bool_or(F.col("_turn").isNull()).alias("_unnumbered")).where(
        "_first < _last OR (_unnumbered AND _last IS NOT NULL)")
    met = salted_join(said, firsts.drop("_last"), ["conv", "_said"], F.xxhash64("_turn"))
    end = F.rtrim("text", F.lit(_BLANKS))
    made = met.select(
        "conv", "present", F.col("_turn").isNotNull().alias("has_turn"), F.coalesce("_turn", F.lit(0)).alias("turn"), "role", "text",
        F.coalesce(F.col("_unnumbered") | (F.col("_first") < F.col("_turn")), F.lit(False)).alias("earlier"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    made = made.withColumn("earlier", F.col("earlier") & F.col("has_turn"))
    return made.repartition("conv").sortWithinPartitions("conv", F.desc("has_turn"), F.desc("turn"), F.desc("role"), F.desc("text")).select(*STREAM)


def _named(found: DataFrame, conversations: DataFrame) -> DataFrame:
    conv = F.when(F.col("conv") != "-", F.substr("conv", F.lit(2))).cast(conversations.schema["conv_id"].dataType)
    return found.select(conv.alias("conv_id"), *found.columns[1:])


def audited(conversations: DataFrame, present: Column | None = None, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role, text; other columns are not read. Rows are ordered by turn (nulls first), role
    and text; null roles and texts are one space; rows of a null conv_id form one conversation. The first fault of a row
    counts: blank (ASCII blanks only), duplicate (role and text seen earlier), truncated (the last character that is no
    blank is none of ``.!?``). ``gaps`` are the turn numbers missing between the least and the greatest, ``illegal`` the
    neighbours whose initials are not su, ua or au. ``audit`` has the letters of the cheapest edits (Keep 0, Rerole 2,
    Delete 3 and forced on blank and duplicate rows, Insert 2; a truncated row that stays 1 more) after which the initials
    match ``(s?(ua)+)?``; of equal costs the least in ASCII. ``repaired_sha256`` is over the repaired ``role:text``, joined by line
    feeds. Rows for which ``present`` is false only name their conversation; one without other rows has zeros, an empty
    audit and the digest of an empty text. An empty table gives no rows.
    """
    return _named(_stream(conversations, present).mapInPandas(_reports(spill_bytes), REPORT), conversations)


def repaired(conversations: DataFrame, present: Column | None = None, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """conv_id, place (from 1), edit, role, text: the edits of :func:`audited` in order; those of deleted rows have neither
    role nor text, all others are the turns of the repaired conversation."""
    return _named(_stream(conversations, present).mapInPandas(_turns(spill_bytes), TURNS), conversations)
