"""Ordered operators that never put one whole group, or one whole table, into a single task.

A plain window pulls each partition key into one task. Here the rows are first cut into slices of the order
columns, windows run per (group, slice), and neighbouring slices exchange one edge row. The cut points come
from an evenly spread sample, so a group or a first value that holds a third of the rows is spread over a
third of the slices. They only decide how work is divided: results are exact for any cut points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_SLICES = 64
SAMPLE_PER_SLICE = 64
EXPLODE_CHUNK = 10_000


def slice_count(df: DataFrame, slices: int | None = None) -> int:
    """The asked number of slices, or as many as the session has shuffle partitions (64 at least)."""
    if slices is not None and slices < 2:
        raise ValueError("slices must be at least 2")
    return slices or max(LEAST_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _order_value(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def slice_bounds(df: DataFrame, order: Sequence[str], slices: int) -> Column:
    """Cut points as a scalar subquery: the rows with the smallest hashes (the same ones in every run, a number in
    proportion to the slices), sorted and taken at equal distances."""
    sample = (df.select(_order_value(order).alias("_value"), F.xxhash64(*df.columns).alias("_hash"))
              .where("_value IS NOT NULL").orderBy("_hash", "_value").limit(SAMPLE_PER_SLICE * slices))
    sorted_values = sample.agg(F.sort_array(F.collect_list("_value")).alias("_sorted"))
    places = F.transform(F.sequence(F.lit(1), F.lit(slices - 1)),
                         lambda i: F.get("_sorted", F.floor(i * F.size("_sorted") / slices).cast("int")))
    return sorted_values.select(places.alias("bounds")).scalar()


def _slice_number(slices: int) -> Column:
    """Number of ``_bounds`` up to ``_value``, by binary search; nulls come first (-1)."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(slices.bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_bounds", at + step - 1) <= F.col("_value"), at + step).otherwise(at))
    return F.when(F.col("_value").isNull(), -1).otherwise(found)


def with_slices(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add ``_slice``: it never decreases along ``order``, and equal order values share one."""
    slices = slice_count(df, slices)
    cut = df.withColumns({"_bounds": slice_bounds(df, order, slices), "_value": _order_value(order)})
    return cut.withColumn("_slice", _slice_number(slices)).drop("_bounds", "_value")


def distinct_with_counts(df: DataFrame, columns: Sequence[str], name: str = "_copies") -> DataFrame:
    """Equal rows folded into one with their number; folded map-side first, so copies never travel."""
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias(name))


def expand_copies(df: DataFrame, name: str = "_copies", number: str | None = None) -> DataFrame:
    """Repeat each row ``name`` times, with the ``number`` of the copy from 1 if a column for it is named. Large repeats are cut into chunks that are spread over tasks; the chunks of one
    row are made in two levels, so that no array grows with the number of copies."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    block = EXPLODE_CHUNK * EXPLODE_CHUNK

    def ranges(upto: Column, size: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((upto - 1) / size).cast("bigint")))

    blocks = df.where(F.col(name) > 0).withColumn("_block", ranges(F.col(name), block))
    in_block = F.least(F.lit(block).cast("bigint"), F.col(name) - F.col("_block") * block)
    chunks = blocks.withColumn("_in_block", in_block).withColumn("_chunk", ranges(F.col("_in_block"), EXPLODE_CHUNK))
    spread = chunks.repartition(*kept, "_block", "_chunk")  # a row per 10 000 copies, not the copies
    in_chunk = F.least(F.lit(EXPLODE_CHUNK).cast("bigint"), F.col("_in_block") - F.col("_chunk") * EXPLODE_CHUNK)
    place = F.col("_block") * block + F.col("_chunk") * EXPLODE_CHUNK + F.col("_copy")
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), in_chunk))).select(*kept, *([place.alias(number)] if number else []))


def with_neighbour(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str,
                   ahead: bool = True, slices: int | None = None) -> DataFrame:
    """Add ``name``: a struct of the next (or previous) row's ``order`` columns in the group, null at the end.

    ``df`` must hold distinct ``(group, order)`` rows, for example from :func:`distinct_with_counts`.
    """
    group, order = list(group), list(order)
    sliced = with_slices(df, order, slices)
    edge = F.struct(*order)
    ends = sliced.groupBy(*group, "_slice").agg((F.min(edge) if ahead else F.max(edge)).alias("_edge"))
    # one row per slice: at most slices + 1 per group, however many rows the group has
    along = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_slice")
    carried = (F.lead("_edge") if ahead else F.lag("_edge")).over(along)
    guests = (ends.withColumn("_edge", carried).where("_edge IS NOT NULL")
              .select(*group, "_slice", "_edge.*", F.lit(1 if ahead else -1).alias("_guest")))
    rows = sliced.withColumn("_guest", F.lit(0)).unionByName(guests, allowMissingColumns=True)
    local = Window.partitionBy(*group, "_slice").orderBy("_guest", *order)
    found = F.lead(edge) if ahead else F.lag(edge)
    return rows.withColumn(name, found.over(local)).where("_guest = 0").drop("_guest", "_slice")


def numbered(df: DataFrame, order: str, name: str, slices: int | None = None) -> DataFrame:
    """``row_number()`` over the whole of ``df`` (distinct ``order`` values), numbered slice by slice."""
    sliced = with_slices(df, [order], slices)
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(order))
    # offsets has at most slices + 1 rows, whatever the size of df
    return (sliced.withColumn("_rn", inside).join(F.broadcast(offsets), "_slice")
            .withColumn(name, F.col("_rn") + F.col("_offset")).drop("_rn", "_offset", "_slice"))

