"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are the context, and only that reply is
trainable. Turns behind the last assistant turn (all turns of a conversation without one) give one more example in
which nothing is trainable, so that no turn is lost.

Template of a turn: ``[TURN]role⏎text[/TURN]``. Inside roles and texts ``&``, ``<`` and ``[`` are written as
entities, so that no control string (each starts with ``<`` or ``[``) can stand there; the line feed of a role is
written as an entity too. ``&`` is escaped first and restored last, which makes the change reversible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template and the entities of its escapes.
OPEN, CLOSE = "[TURN]", "[/TURN]"
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
LINE_FEED = ("\n", "&#10;")


def escaped(text: Column) -> Column:
    for raw, entity in ENTITIES:
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def unescaped(text: Column) -> Column:
    for raw, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(raw))
    return text


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(LINE_FEED[0]), F.lit(LINE_FEED[1]))


def _role_back(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(LINE_FEED[1]), F.lit(LINE_FEED[0])))


def expand(conversations: DataFrame, trainable: str = "assistant") -> DataFrame:
    """conv_id, target (1-based place of the last turn shown), formatted, loss_start, loss_end, complete.

    The loss mask covers the code points from ``loss_start`` (0-based) up to ``loss_end`` of ``formatted``; both are
    equal where nothing is trainable. ``complete`` marks the example that shows the whole conversation. Turns are
    ordered by (turn, role, text), nulls first; null texts and roles are empty; repeated rows are turns of their own;
    rows of a null conv_id form one conversation; an empty table gives none. Other columns are not read.

    An example holds its whole context, so one conversation has to fit into a row; its turns are gathered once and
    its examples are made one at a time, never as a list.
    """
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    pieces = turns.select("conv_id", F.transform("_turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), _role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"),
        (t["role"] == trainable).alias("trained"))).alias("_pieces"))
    count = F.size("_pieces")
    places = F.filter(F.sequence(F.lit(1), count), lambda i: F.get("_pieces", i - 1)["trained"] | (i == count))
    shown = pieces.withColumn("_segments", F.transform(
        "_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE)))).select(
        "conv_id", F.col("_pieces.trained").alias("_trained"), F.transform("_pieces", lambda p: F.length(p["body"])).alias("_lengths"),
        "_segments", F.explode(places).alias("target"))
    formatted = F.array_join(F.slice("_segments", F.lit(1), F.col("target")), "")
    end = F.length("formatted") - len(CLOSE)
    made = shown.select("conv_id", "target", formatted.alias("formatted"), F.get("_trained", F.col("target") - 1).alias("_loss"),
                        F.get("_lengths", F.col("target") - 1).alias("_length"), (F.col("target") == F.size("_segments")).alias("complete"))
    return made.select("conv_id", "target", "formatted", F.when(F.col("_loss"), end - F.col("_length")).otherwise(0).alias("loss_start"),
                       F.when(F.col("_loss"), end).otherwise(0).alias("loss_end"), "complete")


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted example."""
    segments = F.filter(F.split(formatted, r"\[/TURN\]"), lambda s: s != "")
    return F.transform(segments, lambda s: F.struct(
        _role_back(F.substring_index(F.substr(s, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
        unescaped(F.substr(s, F.locate("\n", s) + 1)).alias("text")))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    return unescaped(F.substr(formatted, start + 1, end - start))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: n_turns, turns_sha256 (role, line feed, text, line feed per turn),
    loss_chars, loss_sha256 (all text under the loss masks, in order) and formatted_chars."""
    turns = parsed(F.col("formatted"))
    joined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        "conv_id", "target", F.when(F.col("complete"), F.size(turns)).cast("bigint").alias("_turns"),
        F.when(F.col("complete"), F.sha2(joined, 256)).alias("_sha"), F.length("formatted").cast("bigint").alias("_chars"),
        F.when(F.col("loss_end") > F.col("loss_start"), loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")))
        .otherwise("").alias("_loss"))
    losses = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("target", "_loss"))), lambda e: e["_loss"]), "")
    return (read.groupBy("conv_id")
            .agg(F.max("_turns").alias("n_turns"), F.max("_sha").alias("turns_sha256"), losses.alias("_text"),
                 F.sum("_chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.length("_text").cast("bigint").alias("loss_chars"),
                    F.sha2("_text", 256).alias("loss_sha256"), "formatted_chars"))
