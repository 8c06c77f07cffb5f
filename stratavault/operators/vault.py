"""Data-vault building blocks: hubs, satellites, links, current and latest-batch views.

Sizes and skew: hubs, links and satellites fold their input map-side before anything travels, so a business key
that fills a third of the table costs one row per task. Single-row lookups ("the dimension row called X") are
scalar subqueries, not joins. Where many rows share the key of a small table, the test whether the key is known is
a salted semi-join, so that no session setting decides whether a hot key lands in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.functions.keys import KEY_SEPARATOR, ColumnLike, _column, hash_key
from stratavault.operators.ordering import numbered
from stratavault.operators.relational import deduplicate


def load_columns(load_ts: str, source: str) -> list[Column]:
    """The audit columns; one explicit load time per run."""
    return [F.lit(load_ts).cast("timestamp_ntz").alias("load_date"), F.lit(source).alias("source_system")]


def _named(columns: Mapping[str, ColumnLike]) -> list[Column]:
    return [_column(c).alias(name) for name, c in columns.items()]


def hub(stage: DataFrame, hk: str, keys: Sequence[ColumnLike], columns: Mapping[str, ColumnLike],
        load_ts: str, source: str, sep: str = KEY_SEPARATOR) -> DataFrame:
    """Distinct business keys with their hash key. ``columns`` must depend on the keys alone."""
    listed = stage.select(hash_key(*keys, sep=sep).alias(hk), *_named(columns)).distinct()
    return listed.select("*", *load_columns(load_ts, source))


def satellite(stage: DataFrame, hk: str, keys: Sequence[ColumnLike], attributes: Mapping[str, ColumnLike],
              load_ts: str, source: str, sep: str = KEY_SEPARATOR, keep_all: bool = False) -> DataFrame:
    """Attributes per key and load time: one row per key, the smallest of several by its attributes in order (nulls
    first). ``keep_all`` keeps every row (measure satellites)."""
    rows = stage.select(hash_key(*keys, sep=sep).alias(hk), *_named(attributes))
    if not keep_all:
        whole = F.struct(*[F.col(f"`{a}`") for a in attributes])
        rows = rows.groupBy(hk).agg(F.min(whole).alias("_a")).select(hk, "_a.*")
    audit = load_columns(load_ts, source)
    return rows.select(hk, audit[0], *[F.col(f"`{a}`") for a in attributes], audit[1])


SALTS = 16


def known_keys(rows: DataFrame, keys: DataFrame, key: str, spread: ColumnLike) -> DataFrame:
    """The ``rows`` whose ``key`` occurs in ``keys``: a semi-join in which one key is spread over 16 tasks by a hash
    of ``spread``; the distinct keys are repeated as often."""
    salted = keys.select(F.col(key).alias("_known")).distinct().withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(_column(spread)), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, (dealt[key] == salted["_known"]) & (dealt["_salt"] == salted["_salt"]), "left_semi").drop("_salt")


def measure(text: ColumnLike) -> Column:
    """Money text to ``decimal(15,2)``; a missing amount is zero, an unreadable one null."""
    return F.coalesce(_column(text), F.lit("0")).try_cast("decimal(15,2)")


def _as_link(pairs: DataFrame, link_hk: str, left_hk: str, right_hk: str, load_ts: str, source: str,
             sep: str, distinct: bool = True) -> DataFrame:
    pairs = pairs.select(left_hk, right_hk)
    keyed = (pairs.distinct() if distinct else pairs).select(
        F.when(F.col(left_hk).isNotNull(), hash_key(left_hk, right_hk, sep=sep)).alias(link_hk), left_hk, right_hk)
    return keyed.select("*", *load_columns(load_ts, source))


def link_by_name(stage: DataFrame, left: DataFrame, left_hk: str, stage_name: ColumnLike,
                 right: DataFrame, right_hk: str, right_keys: Sequence[ColumnLike], link_hk: str,
                 load_ts: str, source: str, sep: str = KEY_SEPARATOR) -> DataFrame:
    """Link of two hubs through stage rows. Both keys are computed, the left one from the name, and kept where the hubs
    know them.

    The stage is first folded to distinct (name, key) pairs, so its repeated rows never reach a join. Hubs hold
    one row per key, so the pairs stay distinct.
    """
    pairs = stage.select(hash_key(stage_name).alias(left_hk), hash_key(*right_keys).alias(right_hk)).distinct()
    found = known_keys(pairs, left, left_hk, right_hk).join(right.select(right_hk), right_hk, "left_semi")
    return _as_link(found, link_hk, left_hk, right_hk, load_ts, source, sep, distinct=False)


def key_of(dimension: DataFrame, hk: str, name_column: str, name: str) -> Column:
    """Key of the one dimension row with this name, as a scalar subquery; null when there is none."""
    return dimension.where(F.col(name_column) == name).agg(F.max(hk).alias(hk)).scalar()


def link_to_constant(stage: DataFrame, dimension: DataFrame, dimension_hk: str, name_column: str, name: str,
                     right: DataFrame, right_hk: str, link_hk: str, load_ts: str, source: str,
                     sep: str = KEY_SEPARATOR, keep_missing: bool = False,
                     right_keys: Sequence[ColumnLike] | None = None) -> DataFrame:
    """Link of every key of the hub ``right`` to the one dimension row called ``name``.

    ``keep_missing`` keeps the rows with a null dimension key when no such row exists. With ``right_keys``
    only right keys that occur in the stage are linked, else all of them as long as the stage has any row.
    """
    keys = right.select(right_hk)
    if right_keys is None:
        keys = keys.where(stage.select(F.lit(1)).limit(1).exists())
    else:
        seen = stage.select(hash_key(*right_keys).alias(right_hk)).distinct()
        keys = keys.join(seen, right_hk, "left_semi")
    pairs = keys.select(key_of(dimension, dimension_hk, name_column, name).alias(dimension_hk), right_hk)
    if not keep_missing:
        pairs = pairs.where(F.col(dimension_hk).isNotNull())
    return _as_link(pairs, link_hk, dimension_hk, right_hk, load_ts, source, sep, distinct=False)


def link_between(left: DataFrame, right: DataFrame, left_hk: str, right_hk: str, link_hk: str,
                 load_ts: str, source: str, sep: str = KEY_SEPARATOR) -> DataFrame:
    """Link from a hub that already carries the left key (business layer)."""
    pairs = known_keys(right.select(left_hk, right_hk).distinct(), left, left_hk, right_hk)
    return _as_link(pairs, link_hk, left_hk, right_hk, load_ts, source, sep, distinct=False)


def relink(link: DataFrame, left_hk: str, right_hk: str, link_hk: str, load_ts: str, source: str,
           sep: str = KEY_SEPARATOR) -> DataFrame:
    """The distinct pairs of a link under a fresh link key and load time."""
    return _as_link(link, link_hk, left_hk, right_hk, load_ts, source, sep)


def keyed_dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order, which must be total."""
    return deduplicate(df, keys, order_by)


def upsert_by_key(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Content of a keyed table after loading ``incoming``: the last write of a key wins, whatever its values; within
    one load the first row in the given order."""
    both = current.withColumn("_write", F.lit(0)).unionByName(incoming.withColumn("_write", F.lit(1)))
    return keyed_dedupe(both, keys, [F.desc("_write"), *order_by]).drop("_write")


def latest_per_key(history: DataFrame, hk: str, load_column: str = "load_date",
                   ties: Sequence[Column] = ()) -> DataFrame:
    """The newest row of every key; of several in one load the smallest by ``ties``, by default by all columns."""
    return deduplicate(history, [hk], [F.desc(load_column), *(ties or [F.asc(f"`{c}`") for c in history.columns])])


def latest_batch(history: DataFrame, load_column: str = "load_date") -> DataFrame:
    """Rows of the newest load only; keys missing from that load are absent."""
    return history.where(F.col(load_column) == history.agg(F.max(load_column)).scalar())


def rank_id(df: DataFrame, name_column: str, id_column: str = "id") -> DataFrame:
    """Distinct names numbered from 1 in name order, without a single-task sort."""
    return numbered(df.select(name_column).distinct(), name_column, id_column)


def lasting_ids(names: DataFrame, known: DataFrame | None, name_column: str, id_column: str = "id") -> DataFrame:
    """Distinct names with numbers that last: those in ``known`` (name, number) keep theirs, the others are numbered in name
    order behind the highest. Only unseen names are ordered, in slices; a name that is numbered twice keeps the least number."""
    distinct = names.select(name_column).distinct()
    if known is None:
        return numbered(distinct, name_column, id_column)
    kept = known.groupBy(F.col(name_column).alias("_name")).agg(F.min(id_column).alias(id_column))
    same = F.col(name_column).eqNullSafe(F.col("_name"))
    old = distinct.join(kept, same).select(name_column, F.col(id_column).cast("bigint").alias(id_column))
    unseen = distinct.join(kept.select("_name"), same, "left_anti")
    highest = F.coalesce(known.agg(F.max(id_column)).scalar(), F.lit(0))
    new = numbered(unseen, name_column, "_place").select(name_column, (F.col("_place") + highest).cast("bigint").alias(id_column))
    return old.unionByName(new)
