"""Small column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.operators.ordering import expand_copies
from stratavault.session import materialise

#: Word and blank classes of all operators: ASCII blanks only, so other Unicode spaces are part of words.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SALTS = 16
#: Most bits of a table of names that is sent to every executor (16 MB), and bits for each name until then.
SLOTS = 1 << 27
NAME_SLOTS = 16
#: Narrow rows (ids, hashes, short keys: under 100 bytes) up to this number are sent to every executor.
BROADCAST_ROWS = 500_000


def whole(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """All words of a text, in order; an empty array for a text of blanks."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt: Column, how: str = "left",
                salts: int = SALTS) -> DataFrame:
    """Null-safe equi-join in which a key that holds a third of ``left`` is spread over ``salts`` tasks.

    ``right`` has one row per key and is repeated once per salt; ``salt`` is any well-spread hash of a left row.
    """
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys],
                           F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_r_salt"))
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col("_salt") == F.col("_r_salt")]
    joined = left.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    for condition in on[1:]:
        on[0] = on[0] & condition
    return joined.join(renamed, on[0], how).drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def repeated(df: DataFrame, copies: str, number: str | None = None) -> DataFrame:
    """Each row ``copies`` times, with the ``number`` of the copy from 1 if a column for it is named. ``df`` is stored, so that
    it is computed once; only rows that repeat are dealt out, in chunks."""
    stored = materialise(df, "folded")
    kept = [c for c in df.columns if c != copies]
    single = stored.where(F.col(copies) == 1).select(*kept, *([F.lit(1).cast("bigint").alias(number)] if number else []))
    return single.unionByName(expand_copies(stored.where(F.col(copies) > 1), copies, number))


def tree(parts: Sequence[Column], join: Callable[[Column, Column], Column]) -> Column:
    """Balanced combination of many columns, so that the expression stays shallow."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def slot(*keys: Column, slots: int | None = None) -> Column:
    """Place of a name among ``slots`` (all ``SLOTS``) bits; nulls have one too."""
    return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(slots or SLOTS))


def slots_for(names: int) -> int:
    """Bits for so many names: a power of two that leaves ``NAME_SLOTS`` to each, ``SLOTS`` at most."""
    return min(SLOTS, 1 << max(15, (names * NAME_SLOTS - 1).bit_length()))


def sieved(rows: DataFrame, keys: Sequence[str], names: DataFrame, named: Sequence[str], value: Column | None = None, values: int = 1) -> DataFrame:
    """``rows`` with ``_seen``: the sum of 2^v over all values v (0 to ``values`` - 1) that a name in the row's slot has.

    ``keys`` of a row name it, ``named`` are the columns of ``names`` that hold this. So a row without a name in ``names`` may
    have any ``_seen``, but a row with a name has the bit of its value set: 0 proves that it has no name, and a single bit
    proves the value where all rows have names. All other rows, some (names / slots) of them, have to be joined. What
    is broadcast grows with the names and is bounded at any number of them: ``SLOTS`` / 8 bytes for each value. Rows stay where
    they are. ``names`` is stored, as it is counted first.
    """
    slots = slots_for(names.count())
    place = names.select(slot(*[F.col(c) for c in named], slots=slots).alias("_slot"), (F.lit(0) if value is None else value).alias("_v"))
    dealt = place.select(F.shiftright("_slot", 15).alias("_slots"), F.col("_slot").bitwiseAND(F.lit(32767)).alias("_at"), "_v").repartition("_slots")
    bits = dealt.groupBy("_slots").agg(*[F.expr(f"bitmap_construct_agg(_at) FILTER (WHERE _v = {v})").alias(f"_bits{v}") for v in range(values)])
    found = rows.withColumn("_slot", slot(*[F.col(k) for k in keys], slots=slots)).join(
        F.broadcast(bits), F.shiftright("_slot", 15) == F.col("_slots"), "left")
    byte = "CAST(CONV(HEX(SUBSTRING(_bits{0}, CAST((_slot & 32767) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    seen = [F.coalesce(F.expr(f"(SHIFTRIGHT({byte.format(v)}, CAST(_slot & 7 AS INT)) & 1) * {1 << v}"), F.lit(0)) for v in range(values)]
    return found.select(*rows.columns, tree(seen, lambda a, b: a + b).alias("_seen"))


def packed(documents: DataFrame, text: str = "text") -> DataFrame:
    """Rows as ``_row``, whatever their columns are called, with ``_id`` and ``_mark``, which name them."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_mark"))


def hot_join(left: DataFrame, right: DataFrame, key: str, rows: str, spread: Column, share: int = 1000) -> DataFrame:
    """``left`` with the columns of ``right``, which holds one row per non-null ``key`` of ``left`` and in ``rows`` the
    number of left rows with it.

    Keys with more than 1/``share`` of all rows number fewer than ``share``; these are broadcast, and their rows never
    meet in one task. All others are joined in a shuffle, where the rows that are done already are dealt out by
    ``spread`` (any hash of a left row).
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    values = [c for c in right.columns if c not in (key, rows)]
    hot = right.where(F.col(rows) * share > total).select(F.col(key).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = right.where(F.col(rows) * share <= total).select(F.col(key).alias("_cold"), *[F.col(c).alias(f"_cold_{c}") for c in values])
    first = left.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    dealt = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread.cast(left.schema[key].dataType))
    second = first.withColumn("_dealt", dealt).join(cold, F.col("_dealt") == F.col("_cold"), "left")
    return second.select(*left.columns, *[F.when(F.col("_hot").isNull(), F.col(f"_cold_{c}")).otherwise(F.col(f"_hot_{c}")).alias(c)
                                          for c in values])


def small_batches(documents: DataFrame, most: int = 16 << 20) -> DataFrame:
    """``documents``, after a limit on the bytes that go to Python at once (a lower one of the session stays)."""
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", documents.sparkSession.conf
    size = conf.get(name).rstrip("b")
    if not size.isdigit() or int(size) > most:
        conf.set(name, f"{most}b")
    return documents


def sampled(documents: DataFrame, names: DataFrame, text: str = "text") -> DataFrame:
    """Each row of ``names`` (few, with the id in ``_d``) whose id has rows in ``documents``, with ``_t``, the one of their
    texts with the least hash: however many rows repeat an id, one text of it is kept, and chosen by narrow rows that are
    folded before a shuffle."""
    named = F.broadcast(names.select("_d").distinct())
    hashed = documents.select("doc_id", F.xxhash64(text).alias("_hash"), F.col(text).cast("string").alias("_t"))
    least = hashed.join(named, F.col("doc_id") == F.col("_d"), "left_semi").groupBy(F.col("doc_id").alias("_l")).agg(F.min("_hash").alias("_least"))
    texts = hashed.join(F.broadcast(least), (F.col("doc_id") == F.col("_l")) & (F.col("_hash") == F.col("_least")), "left_semi")
    return texts.groupBy("doc_id").agg(F.min("_t").alias("_t")).join(F.broadcast(names), F.col("doc_id") == F.col("_d"))


def marked(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``_mark``, a hash of the text: (doc_id, _mark) names a row, but for rows that repeat."""
    return documents.withColumn("_mark", F.xxhash64(text))


def only(documents: DataFrame, named: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that ``named`` (doc_id, _mark, rows, stays; all names) lets stay: one of each name, where
    ``rows`` of them repeat in doc_id and text. All columns stay, and their order.

    Bits tell of nearly all rows whether they stay; only those for which they do not, and those that repeat, are shuffled."""
    names = materialise(named.select(F.col("doc_id").alias("_k_id"), F.col("_mark").alias("_k_mark"), F.when(~F.col("stays"), 0).when(
        F.col("rows") == 1, 1).otherwise(2).alias("_k_class")), "names")
    seen = sieved(packed(documents, text), ["_id", "_mark"], names, ["_k_id", "_k_mark"], F.col("_k_class"), 3)
    on = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_mark") == F.col("_k_mark"))
    unsure = seen.where(~F.col("_seen").isin(1, 2)).dropDuplicates(["_id", "_mark"])
    joined = unsure.join(names.where("_k_class > 0").hint("shuffle_hash"), on, "left_semi")
    return seen.where("_seen = 2").select("_row.*").unionByName(joined.select("_row.*"))


def without(documents: DataFrame, names: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` but for the rows named in ``names`` (_k_id, _k_mark; stored). Only rows in the slot of a name are shuffled."""
    seen = sieved(packed(documents, text), ["_id", "_mark"], names, ["_k_id", "_k_mark"])
    on = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_mark") == F.col("_k_mark"))
    joined = seen.where("_seen = 1").join(names.hint("shuffle_hash"), on, "left_anti")
    return seen.where("_seen = 0").select("_row.*").unionByName(joined.select("_row.*"))


def texts_of(documents: DataFrame, names: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents`` named in ``names`` (_d, _m, others; stored), as doc_id, _mark, _text and the other columns of
    ``names``. Only texts in the slot of a name are shuffled."""
    rows = documents.select("doc_id", F.xxhash64(text).alias("_mark"), F.col(text).cast("string").alias("_text"))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m"))
    near = sieved(rows, ["doc_id", "_mark"], names, ["_d", "_m"]).where("_seen = 1").drop("_seen")
    return near.join(names.hint("shuffle_hash"), on).drop("_d", "_m")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long): node, root (the smallest node of its component).

    Alternates large-star and small-star steps until nothing changes; the steps number the logarithm of the longest
    path in practice. Each step is a minimum per node (combined map-side) and a join that broadcasts the nodes with very
    many neighbours, whose edges stay where they are, and is stored before the next one starts.
    """
    def linked(rows: DataFrame) -> DataFrame:
        least = rows.groupBy("u").agg(F.min("v").alias("_m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "_m").alias("m"), "n")
        return hot_join(rows, least, "u", "n", F.xxhash64("v"))

    state = None
    current = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        new = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = new
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = linked(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        near = linked(down)
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v")))
        current = materialise(small.distinct(), "edges")
