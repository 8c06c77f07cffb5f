"""Keyed tables stored by ranges of their key, so that a load costs what its delivery holds.

A table is partitioned by the number of a key range, and a small companion table ``<name>__ranges`` has the lower end and the rows
of each range. A load finds the ranges of its keys, leaves out rows that are stored already as they are, and writes the other
ranges again, one file each. Ranges that outgrow the bound are split at evenly spaced keys. A delivery whose keys lie close
together touches few ranges; hash keys touch as many as there are, up to one per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.operators.vault import keyed_dedupe
from stratavault.session import materialise
from stratavault.sinks import tables as sinks

RANGE = "key_range"
ROWS_PER_RANGE = 1_000_000
#: Rows looked at to place each cut.
SAMPLE_PER_CUT = 64
RANGES_SUFFIX = "__ranges"


@dataclass(frozen=True)
class Loaded:
    """Outcome of a load: rows by what became of them, and the ranges that were written."""

    new: int
    changed: int
    unchanged: int
    removed: int
    ranges_written: int


def keyed_rows(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a keyed table, without the number of their range."""
    return spark.table(name).drop(RANGE)


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`") for k in keys])


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe join by key; ``right`` is reduced to its keys, and to ``_``-prefixed columns."""
    renamed = right.select(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys], *[c for c in right.columns if c.startswith("_")])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"`_key_{k}`"))
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"_key_{k}" for k in keys])


def _stored_ranges(spark: SparkSession, name: str, keys: Sequence[str]) -> DataFrame:
    """key_range, low (null: no lower end), rows. Read from the companion table; made anew from the keys where a load was cut
    off between the two tables."""
    there = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # one row per range
    companion = name + RANGES_SUFFIX
    if not there:
        return _one_range(spark.table(name), keys)
    if sinks.exists(spark, companion):
        known = spark.table(companion)
        if {r[0] for r in known.select(RANGE).collect()} == there:
            return known
    return _open_below(spark.table(name).groupBy(RANGE).agg(F.min(_key(keys)).alias("low"), F.count(F.lit(1)).alias("rows")))


def _one_range(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    kind = rows.select(_key(keys).alias("k")).schema["k"].dataType
    return materialise(rows.sparkSession.range(1).select(F.lit(0).alias(RANGE), F.lit(None).cast(kind).alias("low"), F.lit(0).cast("bigint").alias("rows")), "key-ranges")


def _open_below(ranges: DataFrame) -> DataFrame:
    """The ranges that hold rows; the first of them has no lower end."""
    held = materialise(ranges.where("rows > 0"), "key-ranges")
    place = F.struct(F.col("low").isNotNull().alias("_ended"), "low")
    first = held.agg(F.min(place)).scalar()
    return materialise(held.select(RANGE, F.when(~place.eqNullSafe(first), F.col("low")).alias("low"), "rows"), "key-ranges")


def _routed(rows: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the number of their range, by binary search among the lower ends (one per range)."""
    count = ranges.count()
    ends = ranges.agg(F.sort_array(F.collect_list(F.struct("low", RANGE))).alias("ends")).scalar()
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(count.bit_length()))])
    searched = rows.withColumns({"_ends": ends, "_value": _key(keys)})
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= count) & F.coalesce(F.get("_ends", at + step - 1)["low"] <= F.col("_value"), F.lit(True)), at + step).otherwise(at))
    return searched.withColumn(RANGE, F.get("_ends", place - 1)[RANGE]).drop("_ends", "_value")


def _cuts(rows: DataFrame, sizes: DataFrame, keys: Sequence[str], rows_per_range: int) -> DataFrame:
    """key_range, low: keys at which ranges of more than ``rows_per_range`` rows (key_range, rows) are to be cut."""
    every = max(1, rows_per_range // SAMPLE_PER_CUT)
    sample = rows.where(F.pmod(F.xxhash64(_key(keys)), F.lit(every)) == 0).groupBy(RANGE).agg(F.sort_array(F.collect_list(_key(keys))).alias("_s"))
    pieces = F.ceil(F.col("rows") / rows_per_range).cast("int")
    placed = sample.join(sizes.select(RANGE, pieces.alias("_n")).where("_n > 1"), RANGE)
    at = F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_n")).cast("int")))
    return placed.select(RANGE, F.explode(F.array_distinct(at)).alias("low"))


def _split(rows: DataFrame, ranges: DataFrame, keys: Sequence[str], rows_per_range: int, grown: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` and ``ranges`` after ranges with more than ``grown`` rows were cut; new ranges take the next numbers."""
    sizes = materialise(rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > grown), "keyed-sizes")
    if sizes.isEmpty():
        return rows, ranges
    cuts = _cuts(rows.join(sizes.select(RANGE), RANGE, "left_semi"), sizes, keys, rows_per_range)
    highest = ranges.agg(F.max(RANGE)).first()[0]
    lows = [r["low"] for r in cuts.select("low").orderBy("low").collect()]  # one key per new range
    if not lows:
        return rows, ranges
    made = rows.sparkSession.createDataFrame([(highest + 1 + i, low, 0) for i, low in enumerate(lows)], ranges.select(RANGE, "low", "rows").schema)
    made = made.join(ranges.select(F.col("low").alias("_low")), F.col("low").eqNullSafe(F.col("_low")), "left_anti")
    ranges = materialise(ranges.select(RANGE, "low", "rows").unionByName(made), "key-ranges")
    return _routed(rows.drop(RANGE), ranges, keys), ranges


def _written(rows: DataFrame, ranges: DataFrame, name: str, replaced: Sequence[int] | None) -> int:
    """Write whole ranges, one file each, drop those of ``replaced`` that have no rows left, then write the companion table;
    returns the number of written ranges. ``replaced`` is None for a new table."""
    spark = rows.sparkSession
    sizes = materialise(rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_rows")), "keyed-sizes")
    touched = [r[0] for r in sizes.select(RANGE).collect()]  # one number per range
    dealt = rows.repartition(max(1, len(touched)), RANGE)
    if replaced is None:
        dealt.write.mode("errorifexists").format("parquet").partitionBy(RANGE).saveAsTable(name)
    elif touched:
        sinks.replace_partitions(dealt, name)
    emptied = sorted(set(replaced or ()) - set(touched))
    for number in emptied:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({RANGE} = {number})")
    stays = F.when(F.col(RANGE).isin(emptied), 0).otherwise(F.col("rows"))
    counted = ranges.join(sizes, RANGE, "left").select(F.col(RANGE), "low", F.coalesce(F.col("_rows"), stays).cast("bigint").alias("rows"))
    sinks.rebuild(_open_below(counted).coalesce(1), name + RANGES_SUFFIX)
    return len(touched)


def load_keyed(df: DataFrame, name: str, keys: Sequence[str], order_by: Sequence[Column] = (), rows_per_range: int = ROWS_PER_RANGE,
               compare: Sequence[str] | None = None, removed: DataFrame | None = None) -> Loaded:
    """Load a delivery into a keyed table: one row per key stays, the last write.

    Within one delivery the first row of a key in the given order wins (by default by all columns). A row that equals the
    stored one in ``compare`` (by default all columns) is left out. ``removed`` has keys whose rows go, unless they are
    delivered. Null keys are keys. A range that holds twice ``rows_per_range`` rows is cut.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != RANGE]
    order = list(order_by) or [F.asc(f"`{c}`") for c in columns]
    delivered = materialise(keyed_dedupe(df.select(*[F.col(f"`{c}`") for c in columns]), keys, order), "keyed-delivered")
    if not sinks.exists(spark, name):
        rows, ranges = _split(delivered.withColumn(RANGE, F.lit(0)), _one_range(delivered, keys), keys, rows_per_range, rows_per_range)
        rows = materialise(rows, "keyed-rows")
        return Loaded(rows.count(), 0, 0, 0, _written(rows, ranges, name, None))

    ranges = _stored_ranges(spark, name, keys)
    delivered = _routed(delivered, ranges, keys)
    if removed is not None:
        gone = _same_key(_routed(removed.select(*keys).distinct(), ranges, keys), delivered, keys, "left_anti")
    else:
        gone = delivered.limit(0).select(*keys, RANGE)
    gone = materialise(gone, "keyed-gone")
    met = [r[0] for r in delivered.select(RANGE).unionByName(gone.select(RANGE)).distinct().collect()]  # one number per range
    current = spark.table(name).where(F.col(RANGE).isin(met)).select(*columns, RANGE)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in (compare or columns)])
    stored = current.select(*keys, content.alias("_stored"), F.lit(True).alias("_known"))
    state = F.when(F.col("_known").isNull(), "new").when(F.col("_stored") == content, "unchanged").otherwise("changed")
    judged = materialise(_same_key(delivered, stored, keys, "left").withColumn("_state", state).drop("_stored", "_known"), "keyed-judged")
    vanished = materialise(_same_key(gone, current, keys, "left_semi"), "keyed-vanished")
    found = {r["_state"]: r["n"] for r in judged.groupBy("_state").agg(F.count(F.lit(1)).alias("n")).collect()}
    fresh = judged.where("_state <> 'unchanged'").drop("_state")
    written = [r[0] for r in fresh.select(RANGE).unionByName(vanished.select(RANGE)).distinct().collect()]
    ranges_written = 0
    if written:
        replaced = fresh.select(*keys).unionByName(vanished.select(*keys))
        kept = _same_key(current.where(F.col(RANGE).isin(written)), replaced, keys, "left_anti")
        rows = materialise(kept.unionByName(fresh.select(*columns, RANGE)), "keyed-rows")
        rows, ranges = _split(rows, ranges, keys, rows_per_range, 2 * rows_per_range)
        ranges_written = _written(rows, ranges, name, written)
    return Loaded(found.get("new", 0), found.get("changed", 0), found.get("unchanged", 0), vanished.count(), ranges_written)
