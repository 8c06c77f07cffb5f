import hashlib

from stratavault.llm import chat_format

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROWS = [(1, 0, "system", "be <s> & [INST]"), (1, 1, "user", "&amp; &lt; \n[/TURN]"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 3, "user", "x"),
        (1, 4, "assistant", ""), (2, 0, "user", "only"), (3, 5, "assistant", None), (3, 5, "assistant", "é😀"), (3, None, None, "a"),
        (4, 0, "ro\nle&#10;", "line\nfeed"), (4, 1, "assistant", "y" * 200_000), (4, 2, "user", "tail"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same"),
        (None, 0, "user", "null id")]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark, clashing):
    frame = clashing(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.read_back(chat_format.expand(frame)).collect()}
    assert found == expected(ROWS)


def test_every_assistant_turn_is_an_example_with_only_it_trainable(spark):
    rows = chat_format.expand(spark.createDataFrame(ROWS[:5], SCHEMA)).orderBy("target").collect()
    assert [r.target for r in rows] == [3, 5] and [r.complete for r in rows] == [False, True]
    assert rows[1].formatted.startswith(rows[0].formatted)
    assert rows[0].formatted[rows[0].loss_start:rows[0].loss_end] == "&lt;/s>&#91;INST] ok &#91;/INST]"
    assert all(mark not in rows[0].formatted for mark in ("</s>", "[INST]", "[/INST]", "<s>"))


def test_turns_behind_the_last_reply_and_no_reply_are_kept_untrained(spark):
    rows = chat_format.expand(spark.createDataFrame([ROWS[5]], SCHEMA)).collect()
    assert [(r.target, r.loss_start, r.loss_end, r.complete) for r in rows] == [(1, 0, 0, True)]


def test_empty_table(spark):
    assert chat_format.read_back(chat_format.expand(spark.createDataFrame([], SCHEMA))).collect() == []
