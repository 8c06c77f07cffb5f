"""Benchmark decontamination by SimHash of item-sized windows.

Every start in every text is the start of a window of each item's size. Windows that cannot reach the similarity are
left out first, without loss: a window needs a certain number of shingles of the item, and of all windows with the
same shared shingles the best one starts at such a shingle (or is the last of the text). The windows that remain get a
64-bit SimHash. Candidates are verified by the weighted Jaccard similarity of the shingles, the weight of a shingle
being the number of times it occurs.

No fixed Hamming radius holds all pairs: where an item repeats few shingles, many of its bits are ties or nearly so, and
a single other word turns them. So each item states which of its bits are certain. A window at the similarity differs
from the item in at most ``(1 - s) / (1 + s)`` of the shingles of both, and each of these moves the count behind a bit
by one; bits that are decided by more than that are equal in every such window, and all others are free. The radius of
an item is the number of its free bits, and no pair beyond the similarity lies outside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import marked, texts_of, tree, whole, without, words
from stratavault.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
#: Item shingles up to this number are sent to every executor; more of them take a shuffle join.
BROADCAST_SHINGLES = 1_000_000
_LANE = 0x0000000100000001
_LOW = 0xFFFFFFFF


def _shingles(tokens: Column, width: int) -> Column:
    """Hashes of all ``width`` neighbouring words, in order; empty for a shorter text."""
    last = F.size(tokens) - width
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(width)])))


def _flags(hashes: Column, test: Callable[[Column, Column], Column]) -> Column:
    """64 bits, each the ``test`` of how many of the ``hashes`` have it, and of their number. Two bits are counted in each
    of 32 sums."""
    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"l{k}") for k in range(32)])
    lanes = F.aggregate(hashes, zero, lambda a, h: F.struct(*[
        (a[f"l{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANE))).alias(f"l{k}") for k in range(32)]),
        lambda a: F.array(*[a[f"l{k}"] for k in range(32)]))
    count = F.size(hashes)

    def bits(sums: Column) -> Column:
        set_bits = []
        for k in range(32):
            lane = F.get(sums, F.lit(k))
            set_bits.append(F.when(test(lane.bitwiseAND(F.lit(_LOW)), count), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
            set_bits.append(F.when(test(F.shiftrightunsigned(lane, 32), count), F.lit((1 << k + 32) - (1 << 64) * (k == 31))).otherwise(F.lit(0)).cast("bigint"))
        return tree(set_bits, lambda a, b: a.bitwiseOR(b))
    return F.element_at(F.transform(F.array(lanes), bits), 1)


def simhash(hashes: Column) -> Column:
    """64-bit majority fingerprint of an array of hashes, repeats included."""
    return _flags(hashes, lambda ones, count: ones * 2 > count)


def certain(hashes: Column, similarity: float) -> Column:
    """The bits of ``simhash`` that every window with at least that similarity, and at most as many hashes, shares."""
    return _flags(hashes, lambda ones, count: F.abs(ones * 2 - count) > F.floor(2 * count * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-9)))


def benchmark_items(benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """item_id, _item (a hash of id and text), width (words in a shingle), size (shingles), hashes, fp, certain: one row per
    distinct item that has words."""
    tokens = benchmark.select("item_id", words(F.lower(whole(text))).alias("_w")).where(F.size("_w") > 0).distinct()
    width = F.least(F.size("_w"), F.lit(SHINGLE))
    by_width = tree([F.when(width == k, _shingles(F.col("_w"), k)) for k in range(1, SHINGLE + 1)], F.coalesce)
    rows = tokens.select("item_id", F.xxhash64("item_id", "_w").alias("_item"), width.alias("width"), by_width.alias("hashes"))
    return rows.select("item_id", "_item", "width", F.size("hashes").alias("size"), "hashes", simhash(F.col("hashes")).alias("fp"),
                       certain(F.col("hashes"), similarity).alias("certain"))


def _required(size: Column, shown: Column, similarity: float) -> Column:
    """Fewest shared shingles of an item of ``size`` and a window of ``shown`` shingles at that similarity."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (size + shown) - F.lit(1e-9))


def _windows(texts: DataFrame, items: DataFrame, widths: list[int], similarity: float, broadcast_shingles: int) -> DataFrame:
    """doc_id, _mark, _item, width, size, shown, start: windows that hold enough shingles of an item to reach the
    similarity, and among which each item's best window is."""
    known = items.select("_item", "width", "size", F.explode("hashes").alias("hash")).distinct()
    if known.limit(broadcast_shingles + 1).count() <= broadcast_shingles:
        known = F.broadcast(known)
    exploded = None
    for width in widths:
        rows = texts.select("doc_id", "_mark", F.lit(width).alias("width"), (F.size("_w") - width + 1).alias("_n"),
                            F.posexplode(_shingles(F.col("_w"), width)).alias("_p", "hash"))
        exploded = rows if exploded is None else exploded.unionByName(rows)
    hits = exploded.join(known, ["hash", "width"])
    last = F.greatest(F.col("_n") - F.col("size"), F.lit(0))
    placed = hits.withColumns({"_last": last, "shown": F.least("size", "_n")})
    keys = "PARTITION BY doc_id, _mark, _item"
    # in units of the item's size a window is just under 1 long
    ahead = F.expr(f"count(*) OVER ({keys} ORDER BY CAST(_p AS DOUBLE) / size RANGE BETWEEN CURRENT ROW AND 0.999999999D FOLLOWING)")
    behind = F.expr(f"count_if(_p >= _last) OVER ({keys})")
    counted = placed.withColumns({"_ahead": ahead, "_behind": behind})
    enough = F.when(F.col("_p") <= F.col("_last"), F.col("_ahead")).otherwise(F.col("_behind")) >= _required(F.col("size"), F.col("shown"), similarity)
    return counted.where(enough).select("doc_id", "_mark", "_item", "width", "size", "shown", F.least("_p", "_last").alias("start")).distinct()


def leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text: str = "text",
          broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """doc_id, _mark, item_id, similarity, start (word of the best window): one row per distinct (doc_id, text) and item
    that reach ``similarity``.

    Words are runs without ASCII blanks, lower-cased; shingles have five words, those of a shorter item all its words.
    A window has as many shingles as the item, in a shorter text all that there are. Null and blank texts and items
    never match; rows that repeat count once; null ids are kept; empty tables give no rows; other columns are not read.
    """
    items = materialise(benchmark_items(benchmark, text, similarity), "benchmark-items")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # five at most
    tokens = words(F.lower(whole(text)))
    texts = marked(documents, text).select("doc_id", "_mark", tokens.alias("_w"))
    windows = materialise(_windows(texts, items, widths or [SHINGLE], similarity, broadcast_shingles), "leak-windows")

    # second reading, of the documents with windows only: fingerprints of the windows
    places = windows.groupBy("doc_id", "_mark").agg(F.collect_set(F.struct("width", "start", "shown")).alias("_at"))
    renamed = places.select(F.col("doc_id").alias("_d"), F.col("_mark").alias("_m"), "_at")
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_mark") == F.col("_m"))
    held = texts_of(documents, materialise(renamed, "leak-places"), text).select("doc_id", "_mark", "_at", words(F.lower(whole("_text"))).alias("_w"))
    cut = None
    for width in widths or [SHINGLE]:
        at = held.select("doc_id", "_mark", F.filter("_at", lambda a: a["width"] == width).alias("_at"), _shingles(F.col("_w"), width).alias("_h"))  # noqa: B023
        rows = at.select("doc_id", "_mark", F.explode(F.transform("_at", lambda a: F.struct(
            a["width"].alias("width"), a["start"].alias("start"), a["shown"].alias("shown"),
            F.slice("_h", a["start"] + 1, a["shown"]).alias("hashes")))).alias("_c")).select("doc_id", "_mark", "_c.*")
        cut = rows if cut is None else cut.unionByName(rows)
    shots = cut.withColumn("fp", simhash(F.col("hashes"))).dropDuplicates(["doc_id", "_mark", "width", "start", "shown"])
    named = windows.join(shots.withColumnsRenamed({"doc_id": "_d", "_mark": "_m", "width": "_w", "start": "_s", "shown": "_n"}),
                         on & (F.col("width") == F.col("_w")) & (F.col("start") == F.col("_s")) & (F.col("shown") == F.col("_n")))
    fingerprinted = named.select("doc_id", "_mark", "_item", "size", "shown", "start", "fp", "hashes")

    # fingerprints within the radius of the item: its certain bits are the same
    known = items.select(F.col("_item").alias("_i"), "item_id", F.col("fp").alias("_fp"), F.col("certain").alias("_c"))
    met = fingerprinted.join(known, F.col("_item") == F.col("_i"))
    candidates = met.where(F.col("fp").bitwiseXOR(F.col("_fp")).bitwiseAND(F.col("_c")) == 0)

    # exact similarity
    window = ["doc_id", "_mark", "_item", "item_id", "size", "shown", "start"]
    weights = candidates.select(*window, F.explode("hashes").alias("hash")).groupBy(*window, "hash").agg(F.count(F.lit(1)).alias("_a"))
    own = items.select(F.col("_item").alias("_i"), F.explode("hashes").alias("_h")).groupBy("_i", "_h").agg(F.count(F.lit(1)).alias("_b"))
    shared = weights.join(own, (F.col("_item") == F.col("_i")) & (F.col("hash") == F.col("_h"))).groupBy(*window).agg(
        F.sum(F.least("_a", "_b")).alias("_o"))
    scored = shared.withColumn("similarity", F.col("_o") / (F.col("size") + F.col("shown") - F.col("_o"))).where(F.col("similarity") >= similarity)
    best = scored.groupBy("doc_id", "_mark", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("_s"))).alias("_best"))
    return best.select("doc_id", "_mark", "item_id", "_best.similarity", (-F.col("_best._s")).cast("bigint").alias("start"))


def leaked_pairs(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, similarity, start: the best window of each document and item."""
    found = leaks(documents, benchmark, **options).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("_s"))).alias("_best"))
    return found.select("doc_id", "item_id", "_best.similarity", (-F.col("_best._s")).alias("start"))


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``documents`` without those that hold an item. All columns and all other rows stay."""
    found = leaks(documents, benchmark, text=text, **options).select(F.col("doc_id").alias("_k_id"), F.col("_mark").alias("_k_mark")).distinct()
    return without(documents, materialise(found, "leaked"), text)
