"""Exact deduplication by composable polynomial fingerprints.

The normalised text (ASCII blanks deleted) is read as a polynomial in a fixed base, modulo two primes. Fingerprints of
neighbouring chunks combine by length-shifted arithmetic, ``h(ab) = h(a) * base**len(b) + h(b)``, so the chunks of a
huge document are hashed in parallel tasks and combined afterwards. Documents with equal fingerprints are then compared
chunk by chunk: the smallest and the largest chunk at each place must be the same. These are found map-side first, so
copies do not travel. Groups that fail (hash collisions) are split by comparing each member with one of them until
every class holds equal texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import hot_join, marked, only, repeated, salted_join, small_batches, texts_of
from stratavault.session import materialise

#: Two primes below 2**31 and a base for each.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 69_621_337)
#: Texts of more code points are cut into chunks of so many, which are hashed in tasks of their own.
CHUNK = 1 << 20
#: Bytes of a chunk in the comparison.
COMPARE = 1 << 16
_BLANKS = b"\t\n\x0b\x0c\r "
_BLOCK = 1 << 14


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _BLANKS)


def _powers(primes: tuple[int, ...]) -> list[np.ndarray]:
    tables = []
    for base, prime in zip(BASES, primes, strict=True):
        table = [1]
        for _ in range(_BLOCK - 1):
            table.append(table[-1] * base % prime)
        tables.append(np.array(table[::-1], np.uint64))
    return tables


def hashed(data: bytes, primes: tuple[int, ...], tables: list[np.ndarray]) -> list[int]:
    """Fingerprint of ``data`` per prime."""
    values, out = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), []
    for base, prime, table in zip(BASES, primes, tables, strict=True):
        total = 0
        for i in range(0, len(values), _BLOCK):
            block = values[i:i + _BLOCK]
            total = (total * pow(base, len(block), prime) + int((block * table[-len(block):]).sum() % np.uint64(prime))) % prime
        out.append(total)
    return out


def _prints(text: Column, primes: tuple[int, ...]) -> Column:
    """bytes, the fingerprints h1 and h2, and the shifts s1 and s2 (base ** bytes)."""
    @F.pandas_udf("bytes bigint, h1 bigint, h2 bigint, s1 bigint, s2 bigint")
    def prints(texts: pd.Series) -> pd.DataFrame:
        tables = _powers(primes)
        rows = []
        for text in texts:
            data = normalised(text)
            rows.append([len(data), *hashed(data, primes, tables), *(pow(b, len(data), p) for b, p in zip(BASES, primes, strict=True))])
        return pd.DataFrame(rows, columns=["bytes", "h1", "h2", "s1", "s2"], dtype="int64")
    return prints(text)


def _digest(text: Column) -> Column:
    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(normalised(t)).hexdigest() for t in texts], dtype="object")
    return digest(text)


def _cut(chunk: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, mark, text in batch.itertuples(index=False):
                for place in range(0, len(text), chunk):
                    yield pd.DataFrame({"doc_id": pd.array([doc_id], "Int64"), "_mark": [mark], "place": [place // chunk],
                                        "piece": [text[place:place + chunk]]})
    return cut


def _combined(pieces: Column, primes: tuple[int, ...]) -> Column:
    """Fingerprint of a text from those of its pieces in order."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("bytes"), zero.alias("h1"), zero.alias("h2"))
    return F.aggregate(pieces, start, lambda a, p: F.struct(
        (a["bytes"] + p["bytes"]).alias("bytes"), ((a["h1"] * p["s1"] + p["h1"]) % primes[0]).alias("h1"),
        ((a["h2"] * p["s2"] + p["h2"]) % primes[1]).alias("h2")))


def fingerprinted(documents: DataFrame, text: str = "text", chunk: int = CHUNK, primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """doc_id, _mark, chars, sha256, key (of the normalised text), rows: one row per distinct (doc_id, text)."""
    rows = marked(small_batches(documents), text).select("doc_id", "_mark", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("chars", F.length("text").cast("bigint"))
    short = (rows.where(F.col("chars") <= chunk)
             .select("doc_id", "_mark", "chars", _digest(F.col("text")).alias("sha256"), _prints(F.col("text"), primes).alias("_p"))
             .groupBy("doc_id", "_mark", "chars", "sha256", F.struct("_p.bytes", "_p.h1", "_p.h2").alias("_f")).agg(F.count(F.lit(1)).alias("rows")))
    long = rows.where(F.col("chars") > chunk)
    facts = long.select("doc_id", "_mark", "chars", _digest(F.col("text")).alias("sha256")).groupBy("doc_id", "_mark", "chars", "sha256").agg(
        F.count(F.lit(1)).alias("rows"))
    pieces = (long.select(F.col("doc_id").cast("bigint").alias("doc_id"), "_mark", "text")
              .mapInPandas(_cut(chunk), "doc_id bigint, _mark bigint, place bigint, piece string")
              .repartition("doc_id", "_mark", "place")
              .select(F.col("doc_id").alias("_d"), F.col("_mark").alias("_m"), F.struct("place", _prints(F.col("piece"), primes).alias("p")).alias("_e"))
              .groupBy("_d", "_m").agg(F.sort_array(F.collect_set("_e")).alias("_e")))  # as many as a text has chunks
    prints = pieces.select("_d", "_m", _combined(F.transform("_e", lambda e: e["p"]), primes).alias("_f"))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m"))
    joined = facts.join(prints, on).select("doc_id", "_mark", "chars", "sha256", "_f", "rows")
    key = F.concat_ws("-", F.hex("_f.bytes"), F.hex("_f.h1"), F.hex("_f.h2"))
    return short.unionByName(joined).select("doc_id", "_mark", "chars", "sha256", key.alias("key"), "rows")


def _slices(size: int):
    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, doc_id, mark, text in batch.itertuples(index=False):
                data = normalised(text)
                parts = [data[i:i + size] for i in range(0, len(data), size)]
                for i in range(0, len(parts), 256):
                    n = len(parts[i:i + 256])
                    yield pd.DataFrame({"key": [key] * n, "doc_id": pd.array([doc_id] * n, "Int64"), "_mark": [mark] * n,
                                        "place": list(range(i, i + n)), "part": parts[i:i + 256]})
    return slices


def _parts(documents: DataFrame, members: DataFrame, text: str, size: int) -> DataFrame:
    """key, doc_id, _mark, place, part: the normalised texts of ``members`` in chunks."""
    texts = texts_of(documents, members.select("key", F.col("doc_id").alias("_d"), F.col("_mark").alias("_m")), text)
    return texts.select("key", F.col("doc_id").cast("bigint").alias("doc_id"), "_mark", "_text").mapInPandas(
        _slices(size), "key string, doc_id bigint, _mark bigint, place bigint, part binary")


def _place() -> Column:
    """Order in a class: most code points, then the smallest doc_id, nulls last."""
    return F.struct((-F.col("chars")).alias("_c"), F.col("doc_id").isNull().alias("_n"), "doc_id", "_mark")


def _resolved(documents: DataFrame, members: DataFrame, text: str, size: int) -> DataFrame:
    """``members`` of groups that hold different texts, with keys that tell these apart."""
    parts = materialise(_parts(documents, members, text, size), "dedup-parts")
    pending, done, turn = members, None, 0
    while not pending.isEmpty():
        first = pending.groupBy("key").agg(F.min(_place()).alias("_f")).select(
            F.col("key").alias("_k"), F.col("_f.doc_id").alias("_fd"), F.col("_f._mark").alias("_fm"))
        example = parts.join(first, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_fd")) & (F.col("_mark") == F.col("_fm")))
        example = example.select("key", "place", F.col("part").alias("_part")).dropDuplicates(["key", "place"])
        compared = salted_join(parts, example, ["key", "place"], F.xxhash64("doc_id", "_mark"))
        other = compared.where("NOT (part <=> _part)").select(F.col("doc_id").alias("_d"), F.col("_mark").alias("_m")).distinct()
        on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m"))
        same = pending.join(other, on, "left_anti").withColumn("key", F.concat("key", F.lit(f"#{turn}")))
        done = same if done is None else done.unionByName(same)
        pending = materialise(pending.join(other, on, "left_semi"), "dedup-pending")
        parts, turn = parts.join(pending.select(F.col("doc_id").alias("_d"), F.col("_mark").alias("_m")), on, "left_semi"), turn + 1
    return done


def classes(documents: DataFrame, text: str = "text", chunk: int = CHUNK, compare: int = COMPARE, primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, _mark, chars, sha256, rows, first (doc_id and _mark of the row that
    stays), group_size (rows of the class).

    Texts are equal if identical after deleting ``[\\x20\\x09-\\x0D]``; null counts as empty, and all empty texts are
    equal. The row with the most code points in the original text stays, then that with the smallest doc_id (nulls
    last), then of rows equal in doc_id the one with the smallest hash. An empty table gives no rows; other columns are
    not read.
    """
    units = materialise(fingerprinted(documents, text, chunk, primes), "dedup-units")
    several = materialise(hot_join(units, units.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("members")),
                                   "key", "n", F.xxhash64("doc_id", "_mark")).where("members > 1").drop("members"), "dedup-several")
    at_place = _parts(documents, several, text, compare).groupBy("key", "place").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    broken = materialise(at_place.where("low <> high").select("key").distinct(), "dedup-broken")
    if not broken.isEmpty():
        apart = _resolved(documents, several.join(broken, "key", "left_semi").select(units.columns), text, compare)
        units = materialise(units.join(broken, "key", "left_anti").unionByName(apart), "dedup-units")
    found = units.groupBy("key").agg(F.min(_place()).alias("_f"), F.sum("rows").alias("group_size"), F.count(F.lit(1)).alias("members"))
    found = found.select("key", "members", F.struct("_f.doc_id", "_f._mark").alias("first"), "group_size")
    return hot_join(units, materialise(found, "dedup-classes"), "key", "members", F.xxhash64("doc_id", "_mark"))


def _stays() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_mark") == F.col("first._mark"))


def duplicates(documents: DataFrame, **options) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text). Of rows
    that repeat in doc_id and text one is kept at most."""
    found = classes(documents, **options).select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", _stays().alias("_stays"),
                                                 F.col("sha256").alias("text_sha256"), "rows")
    return repeated(found, "rows", "_copy").select("doc_id", "keep_id", "group_size", (F.col("_stays") & (F.col("_copy") == 1)).alias("kept"), "text_sha256")


def deduplicated(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """``documents`` with one row of each class of equal texts. All columns stay."""
    return only(documents, classes(documents, text=text, **options).select("doc_id", "_mark", "rows", _stays().alias("stays")), text)
