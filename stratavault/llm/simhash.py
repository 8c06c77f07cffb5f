"""SimHash near-deduplication by the general pigeonhole principle.

Fingerprints that differ in at most ``distance`` bits agree, in one of several groups of bits, up to the threshold of
that group, if the thresholds of ``m`` groups sum to ``distance - m + 1`` (-1: the group is not probed). Correlated bits
go into one group; dynamic programming deals out the thresholds by estimated numbers of candidates and probes, and the
number of groups is chosen by the same cost. A threshold ``t`` is probed by exact keys: the group without each choice of
``t`` of its bits. Every candidate is verified on all 64 bits.

Buckets of equal keys are compared within themselves. A bucket that is too large is split again: the bits outside its
key differ in at most ``distance`` places, so one of ``distance + 1`` parts of them agrees. A bucket whose key leaves
``r`` bits open has at most ``2**r`` members, so splitting ends, loses nothing and needs no cap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.llm.base import components, hot_join, marked, only, small_batches
from stratavault.session import materialise

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2
#: Buckets up to this size are compared within themselves; larger ones are split first. At least 2**(BITS // 8).
BUCKET = 256
#: Fingerprints (those with the smallest hashes) from which numbers of candidates are estimated.
SAMPLE = 4096
#: Cost of shuffling one key, in comparisons of two fingerprints.
KEY_COST = 20
_HASHES = 65_536
_ALL = (1 << BITS) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a whole text; 0 for a text without words. Hashes are counted in pieces of bounded
    size, so memory does not grow with 64 times the text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    width = min(shingle, len(found))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(found) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), _HASHES):
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[i:i + _HASHES], ends[i:i + _HASHES], strict=True)),
                             np.dtype("<u8"))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return of(text)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _correlation(nodes: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all fingerprints; a fixed number of sums reaches the driver."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            ones = _bits(batch["fp"].to_numpy()).astype(np.float64)
            total, n = total + ones.T @ ones, n + len(ones)
        if n:
            yield pd.DataFrame({"place": np.arange(BITS * BITS + 1), "total": np.append(total.ravel(), n)})

    found = nodes.select("fp").mapInPandas(sums, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    if not found:
        return np.zeros((BITS, BITS))
    flat = np.zeros(BITS * BITS + 1)
    for row in found:
        flat[row["place"]] = row["total"]
    n, both = flat[-1], flat[:-1].reshape(BITS, BITS)
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs((both / n - np.outer(mean, mean)) / np.outer(spread, spread))


def _grouped(related: np.ndarray, m: int) -> list[list[int]]:
    """Bits in ``m`` groups of nearly equal size; each group takes the bit most correlated with what it holds."""
    left, groups = set(range(BITS)), []
    for g in range(m):
        size = BITS // m + (g < BITS % m)
        rest = sorted(left)
        group = [max(rest, key=lambda b: related[b, rest].sum())]
        left.discard(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: related[b, group].sum())
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (from -1) whose sum is ``total`` at the least cost; ``costs[i][t + 1]`` is that of ``t`` in group i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(group, -1):
                if done + t not in after or cost + more < after[done + t][0]:
                    after[done + t] = (cost + more, [*chosen, t])
        best = after
    return best.get(total, (math.inf, []))


def plan(nodes: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE) -> list[int]:
    """Masks of bits: any two fingerprints within ``distance`` agree under at least one of them."""
    count = nodes.count()
    related = _correlation(nodes)
    seen = [r["fp"] for r in nodes.select("fp", F.xxhash64("fp").alias("_h")).orderBy("_h", "fp").limit(sample).collect()]
    fps = np.array(seen, np.int64).view(np.uint64)
    pairs, compared = count * (count - 1) / 2, max(1, len(fps) * (len(fps) - 1) // 2)
    best, masks = math.inf, [0]
    for m in range(1, distance + 3):
        groups = _grouped(related, m)
        costs = []
        for group in groups:
            mask = np.uint64(_mask(group))
            near = np.zeros(distance + 1)
            for i in range(0, len(fps), 256):
                apart = np.bitwise_count((fps[i:i + 256, None] ^ fps[None, :]) & mask)
                near += [(apart <= t).sum() for t in range(distance + 1)]
            shares = ((near - len(fps)) / 2 + 0.5) / compared
            costs.append([0.0] + [count * KEY_COST * math.comb(len(group), t) + pairs * shares[t] for t in range(distance + 1)])
        cost, thresholds = allocate(costs, distance - m + 1)
        if cost < best:
            best = cost
            masks = [_mask(group) & ~_mask(list(gone)) for group, t in zip(groups, thresholds, strict=True) if t >= 0
                     for gone in combinations(group, t)]
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _split(mask: int, distance: int) -> list[int]:
    """Larger masks: fingerprints equal under ``mask`` and within ``distance`` are equal under one of them."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    parts = min(distance + 1, len(open_bits))
    return [mask | _mask(open_bits[p::parts]) for p in range(parts)]


def _linked(distance: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out_a, out_b = [], []
            for members in batch["fps"]:
                fps = np.sort(np.asarray(members, np.int64))
                raw = fps.view(np.uint64)
                near = np.bitwise_count(raw[:, None] ^ raw[None, :]) <= distance
                roots = np.arange(len(fps))
                while True:
                    less = np.where(near, roots[None, :], len(fps)).min(axis=1)
                    if (less == roots).all():
                        break
                    roots = less
                moved = roots != np.arange(len(fps))
                out_a.append(fps[moved])
                out_b.append(fps[roots[moved]])
            yield pd.DataFrame({"a": np.concatenate(out_a) if out_a else [], "b": np.concatenate(out_b) if out_b else []}, dtype="int64")
    return links


def link(nodes: DataFrame, masks: list[int], distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints of ``nodes`` (fp) that are within ``distance``: of each
    bucket a star per connected part, never all its pairs."""
    spark: SparkSession = nodes.sparkSession
    keys = F.transform(F.array(*[F.lit(_signed(m)) for m in masks]), lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(m).alias("key")))
    current = nodes.select("fp", F.explode(keys).alias("_k")).select("fp", "_k.mask", "_k.key")
    found = None
    while True:
        sizes = current.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        named = sizes.select(F.xxhash64("mask", "key").alias("_b"), F.col("mask").alias("_m"), F.col("key").alias("_k"), "members", F.col("members").alias("n"))
        met = hot_join(current.withColumn("_b", F.xxhash64("mask", "key")), materialise(named, "simhash-sizes"), "_b", "n", F.xxhash64("fp"))
        held = materialise(met.where("_m = mask AND _k = key").select("mask", "key", "fp", "members"), "simhash-buckets")
        small = held.where(F.col("members") <= bucket).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        edges = small.select("fps").mapInPandas(_linked(distance), "a bigint, b bigint")
        found = edges if found is None else found.unionByName(edges)
        large = held.where(F.col("members") > bucket)
        used = [r["mask"] for r in large.select("mask").distinct().collect()]  # at most 3 times as many as before, five times over
        if not used:
            return found
        parts = [(mask, _signed(part)) for mask in used for part in _split(mask & _ALL, distance)]
        steps = spark.createDataFrame(parts, "mask bigint, part bigint")
        current = large.select("fp", "mask").join(F.broadcast(steps), "mask").select(
            "fp", F.col("part").alias("mask"), F.col("fp").bitwiseAND(F.col("part")).alias("key")).distinct()


def clusters(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, bucket: int = BUCKET, text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, _mark, fp, first (doc_id and _mark of the component's first row).

    Words are runs without ASCII blanks, A-Z lower-cased; shingles are ``shingle`` words joined by a blank, repeats
    included; a shorter text is one shingle. Null and blank texts have fingerprint 0 and are linked like any other.
    Documents are linked if their fingerprints differ in at most ``distance`` bits; components follow links. ``first`` is
    the smallest (doc_id, hash of the text), null doc_ids last. Rows that repeat are returned as often as they come; an
    empty table gives none; other columns are not read.
    """
    rows = marked(small_batches(documents), text).select("doc_id", "_mark", fingerprints(F.col(text).cast("string"), shingle).alias("fp"))
    marks = materialise(rows, "simhash-marks")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_mark")
    nodes = materialise(marks.groupBy("fp").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows")), "simhash-nodes")
    roots = materialise(components(link(nodes, plan(nodes, distance), distance, bucket)), "simhash-roots")
    members = nodes.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "first")
    firsts = members.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("members"))
    placed = hot_join(members.select("fp", "root"), firsts, "root", "members", F.xxhash64("fp")).select(F.col("fp").alias("_fp"), "least")
    known = nodes.join(placed, F.col("fp") == F.col("_fp"), "left").select("fp", "rows", F.coalesce("least", "first").alias("first"))
    return hot_join(marks, materialise(known, "simhash-known"), "fp", "rows", F.xxhash64("doc_id", "_mark"))


def near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component, null if all are null)."""
    return clusters(documents, **options).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def deduplicated(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """``documents`` with one row of each component: that with the smallest doc_id. All columns stay."""
    found = clusters(documents, text=text, **options)
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_mark") == F.col("first._mark"))
    return only(documents, found.groupBy("doc_id", "_mark").agg(F.count(F.lit(1)).alias("rows"), F.max(stays).alias("stays")), text)
