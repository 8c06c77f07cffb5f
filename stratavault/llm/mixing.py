"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times. The whole part is certain. Of ``R`` rows that are
equal in id, source and text ``floor(R * fraction)`` are taken once more for certain, so that at most one row's worth
of them is open. What is open is rounded dependently: two documents meet, words are moved from one to the other at random until one of the two
fractions is 0 or 1, and the other one meets the next, smaller document. Expectations stay, and the words of a source stay
what they were but for the last document. Documents meet inside blocks of bounded size, the residual of each block
goes up to the next level, and so on up the reduction tree; levels grow with the logarithm of the largest source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavault.llm.base import BROADCAST_ROWS, packed, repeated, salted_join, sieved, whole, words
from stratavault.operators.ordering import numbered
from stratavault.session import materialise

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 256
SEED = 20
_NEAR = 1e-12


def sized(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size (words), _mark (a hash of the text), rows: equal rows folded."""
    rows = documents.select("doc_id", "source", F.size(words(whole(text))).cast("bigint").alias("size"),
                            F.xxhash64(text).alias("_mark"))
    return rows.groupBy("doc_id", "source", "size", "_mark").agg(F.count(F.lit(1)).alias("rows"))


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target, units (their number), one row per source.

    Sources by code point, null last, weigh ``weights``, repeating. The level is found as the excess is reshared:
    sources above ``most`` times their size stop there, the rest share what is left by weight, until none is above.
    """
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    ordered = numbered(sources.withColumn("_order", F.struct(F.col("source").isNull().alias("last"), "source")), "_order", "_place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    known = materialise(ordered.select("source", "source_size", "units", weight.cast("bigint").alias("weight")), "mix-sources")
    whole_size = known.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        above = F.lit(stopped >= 0) & (most * F.col("source_size") <= F.lit(level) * F.col("weight"))
        left = known.agg(F.sum(F.when(above, most * F.col("source_size")).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))),
                         F.count(F.when(above, 1))).first()
        if left[2] == stopped or not left[1]:
            break
        stopped, level = left[2] or 0, (whole_size - left[0]) / left[1]
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.lit(level) * F.col("weight"))
    return known.select("source", "source_size", target.alias("target"), "units")


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)


def _meet(level: int, seed: int):
    """One step of the fold over a block: (residual, decided units) and a unit -> the same with one more decided."""
    def step(state: Column, unit: Column) -> Column:
        held = state["held"]
        gain = F.least((1 - held["p"]) * held["mass"], unit["p"] * unit["mass"])
        loss = F.least(held["p"] * held["mass"], (1 - unit["p"]) * unit["mass"])
        up = _uniform(F.lit(seed), F.lit(level), held["mark"], held["doc_id"], unit["mark"], unit["doc_id"]) < F.coalesce(
            F.try_divide(loss, gain + loss), F.lit(0.5))
        held_ends = F.when(up, (1 - held["p"]) * held["mass"] <= unit["p"] * unit["mass"]).otherwise(
            held["p"] * held["mass"] <= (1 - unit["p"]) * unit["mass"])
        moved = F.when(up, gain).otherwise(-loss)
        unit_p = unit["p"] - moved / unit["mass"]
        held_p = held["p"] + moved / held["mass"]
        clipped = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
        rest = F.when(held_ends, unit.withField("p", clipped(unit_p))).otherwise(held.withField("p", clipped(held_p)))
        ended = F.when(held_ends, held.withField("p", F.when(up, 1.0).otherwise(0.0))).otherwise(
            unit.withField("p", F.when(up, 0.0).otherwise(1.0)))
        first = held.isNull()
        return F.struct(F.when(first, unit).otherwise(rest).alias("held"),
                        F.when(first, state["done"]).otherwise(F.concat(state["done"], F.array(ended))).alias("done"))
    return step


def rounded(units: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``units`` (doc_id, source, mark, mass, p, units: fractional units of the source at most) -> the same rows with
    p 0 or 1."""
    fields = ["doc_id", "mark", "mass", "p"]
    most = units.agg(F.max("units")).first()[0] or 0
    current, done, level = units, [], 0
    while True:
        blocks = F.ceil(F.col("units") / block)
        dealt = current.withColumns({"_blocks": blocks, "_block": F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "mark", "doc_id"), blocks)})
        grouped = dealt.groupBy("source", "_block", "_blocks").agg(F.sort_array(F.collect_list(F.struct("mass", "mark", "doc_id", "p")), asc=False).alias("_units"))
        kind = grouped.schema["_units"].dataType
        start = F.struct(F.lit(None).cast(kind.elementType).alias("held"), F.array().cast(kind).alias("done"))
        folded = grouped.withColumn("_end", F.aggregate("_units", start, _meet(level, seed)))
        out = folded.select("source", "_blocks", F.explode(F.concat(
            F.transform("_end.done", lambda u: F.struct(u.alias("unit"), F.lit(True).alias("ended"))),
            F.array(F.struct(F.col("_end.held").alias("unit"), F.lit(False).alias("ended"))))).alias("_e"))
        stored = materialise(out.select("source", "_blocks", "_e.ended", *[F.col(f"_e.unit.{f}").alias(f) for f in fields]), f"mix-level{level}")
        done.append(stored.where("ended").select("source", *fields))
        residual = stored.where("NOT ended")
        if most <= block:
            last = _uniform(F.lit(seed), F.lit(-1), "mark", "doc_id") < F.col("p")
            done.append(residual.select("source", *fields).withColumn("p", F.when(last, 1.0).otherwise(0.0)))
            break
        current = residual.select("source", F.col("_blocks").alias("units"), *fields)
        most, level = math.ceil(most / block), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def decide(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK,
           seed: int = SEED, text: str = "text", most_sources: int = BROADCAST_ROWS) -> DataFrame:
    """One row per distinct (doc_id, source, text): doc_id, source, _mark, rows, size, source_size, target, copies, more.

    ``copies`` is how often each of the ``rows`` is taken, and ``more`` of them once more; at most ``most`` times in all.
    However often a row repeats, a source misses its target by one copy of its last document at most. Null texts have size
    0, and texts without words are not taken; null sources form a source of their own; null doc_ids are kept; an empty
    table gives none. Other columns are not read. The targets of
    up to ``most_sources`` sources are sent to every executor; more of them are joined in a salted shuffle.
    """
    units = materialise(sized(documents, text), "mix-units")
    shares = targets(units, weights, most)
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    if shares.limit(most_sources + 1).count() <= most_sources:
        named = F.broadcast(shares.withColumnRenamed("source", "_s"))
        joined = units.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    else:
        joined = salted_join(units, shares, ["source"], F.xxhash64("doc_id", "_mark"))
    joined = joined.withColumn("_rate", F.least(rate + _NEAR, F.lit(float(most))))
    split = joined.withColumns({"_sure": F.floor("_rate"), "_p": F.col("_rate") - F.floor("_rate")})
    split = split.withColumn("_p", F.when((F.col("_p") < 2 * _NEAR) | (F.col("size") == 0), 0.0).otherwise(F.col("_p")))
    wanted = F.col("rows") * F.col("_p")
    split = split.withColumns({"_more": F.floor(wanted + _NEAR), "_open": F.greatest(wanted - F.floor(wanted + _NEAR), F.lit(0.0))})
    split = split.withColumn("_open", F.when(F.col("_open") < 2 * _NEAR, 0.0).otherwise(F.col("_open")))
    facts = materialise(split.select("doc_id", "source", "_mark", "rows", "size", "source_size", "target", "units", "_sure", "_more", "_open"), "mix-facts")
    open_units = facts.where("_open > 0").select("doc_id", "source", F.col("_mark").alias("mark"), F.col("size").alias("mass"), F.col("_open").alias("p"), "units")
    bits = rounded(open_units, block, seed).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("mark").alias("_m"), F.col("p").alias("_bit"))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_mark") == F.col("_m"))
    taken = lambda c: F.when(F.col("size") == 0, 0).otherwise(c).cast("bigint")
    return facts.join(bits, on, "left").select("doc_id", "source", "_mark", "rows", "size", "source_size", "target", taken(F.col("_sure")).alias("copies"),
                                               taken(F.col("_more") + F.coalesce("_bit", F.lit(0.0))).alias("more"))


def mixed(documents: DataFrame, **options) -> DataFrame:
    """One row per row of ``documents``: doc_id, size, source_size, target, taken (words, repeats counted)."""
    found = repeated(decide(documents, **options).select("doc_id", "size", "source_size", "target", "copies", "more", "rows"), "rows", "_copy")
    once_more = (F.col("_copy") <= F.col("more")).cast("bigint")
    return found.select("doc_id", "size", "source_size", "target", ((F.col("copies") + once_more) * F.col("size")).alias("taken"))


def take(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that the mix takes, all columns, with ``copies``: how often each is to be read.
    A column of that name gives way. Of rows equal in id, source and text, those with the least hashes are read more often."""
    decided = decide(documents, text=text, **options).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_mark").alias("_m"), "rows", F.col("copies").alias("_copies"), F.col("more").alias("_more"))
    decided = materialise(decided, "mix-decided")
    kept = [c for c in documents.columns if c != "copies"]

    # numbers up to MOST of rows that do not repeat are told by bits; the other rows are joined
    class_ = F.when(F.col("rows") == 1, F.least(F.col("_copies") + F.col("_more"), F.lit(MOST + 1))).otherwise(MOST + 1)
    rows = packed(documents.select(*kept), text).withColumn("_source", F.col("_row.source"))
    seen = sieved(rows, ["_id", "_source", "_mark"], decided, ["_d", "_s", "_m"], class_, MOST + 2)
    sure = [1 << n for n in range(MOST + 1)]
    number = F.coalesce(*[F.when(F.col("_seen") == 1 << n, F.lit(n)) for n in range(1, MOST + 1)]).cast("bigint")
    told = seen.where(F.col("_seen").isin(sure[1:])).select("_row.*", number.alias("copies"))
    unsure = seen.where(~F.col("_seen").isin(sure))
    on = F.col("_id").eqNullSafe(F.col("_d")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_mark") == F.col("_m"))
    single = decided.where("rows = 1 AND _copies + _more > 0").drop("rows")
    found = told.unionByName(unsure.join(single.hint("shuffle_hash"), on).select("_row.*", (F.col("_copies") + F.col("_more")).alias("copies")))
    several = decided.where("rows > 1 AND (_copies > 0 OR _more > 0)").drop("rows")
    if several.isEmpty():
        return found
    # rows that repeat are numbered by the partitions in which they were stored, never all in one task
    unit = ["_d", "_s", "_m"]
    dealt = unsure.withColumns({"_part": F.spark_partition_id(), "_order": F.xxhash64("_row")})
    stored = materialise(dealt.join(several.hint("shuffle_hash"), on), "mix-repeated")
    sizes = stored.groupBy(*unit, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*unit).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*[F.col(c).alias(f"_o{c}") for c in (*unit, "_part")], F.coalesce(before, F.lit(0)).alias("_before"))
    same = F.lit(True)
    for c in (*unit, "_part"):
        same = same & F.col(c).eqNullSafe(F.col(f"_o{c}"))
    placed = stored.withColumn("_rn", F.row_number().over(Window.partitionBy(*unit, "_part").orderBy("_order"))).join(offsets, same)
    copies = F.col("_copies") + (F.col("_rn") + F.col("_before") <= F.col("_more")).cast("bigint")
    return found.unionByName(placed.select("_row.*", copies.alias("copies")).where("copies > 0"))
