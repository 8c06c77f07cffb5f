"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models over words and word beginnings; the probabilities of the
earlier categories are inputs of the later models. In training these inputs come from out-of-fold predictions, so that a
later model sees earlier ones as wrong as they will be on new documents.

Of the categories only ``toxic`` is labelled. ``severe`` is toxic with at least the median rate of toxic terms (terms
that nearly always come with the label), ``toxic_junk`` is toxic and of bad quality.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import sampled, small_batches
from stratavault.llm.quality import held_out
from stratavault.session import materialise

CATEGORIES = ("toxic", "severe", "toxic_junk")
#: Bound of the training sample: labelled documents (those with the smallest hashes), and characters of one of them.
TRAIN_DOCUMENTS = 6000
TRAIN_CHARS = 60_000
TERMS = 800
FOLDS = 3
STEPS = 150
RATE = 0.1
PENALTY = 1e-3
_SHORTEST, _LONGEST = 4, 9
_PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^@…“”‘’«»¿¡"
_MEMORY = 200_000


def word_counts(text: str | None) -> Counter[str]:
    """Words of a whole text, lower-cased, without punctuation around them, with their numbers."""
    found: Counter[str] = Counter()
    for token, count in Counter((text or "").lower().split()).items():
        found[token.strip(_PUNCTUATION)] += count
    del found[""]
    return found


def terms_of(word: str) -> list[str]:
    """The word itself, marked by ``=``, and its beginnings."""
    return ["=" + word, *(word[:n] for n in range(_SHORTEST, min(_LONGEST, len(word) - 1) + 1))]


@dataclass(frozen=True)
class Chain:
    places: dict[str, int]
    weights: list[np.ndarray]
    threshold: float
    heads: frozenset[str] = field(default_factory=frozenset)


def describe(text: str | None, places: dict[str, int], heads: frozenset[str], known: dict[str, tuple[int, ...]]) -> tuple[list[int], list[int], int]:
    """Places and numbers of the known terms of a text, and its words. ``known`` remembers words seen before."""
    found: Counter[int] = Counter()
    total = 0
    for word, count in word_counts(text).items():
        total += count
        at = known.get(word)
        if at is None:
            at = tuple(places[t] for t in terms_of(word) if t in places) if word[:_SHORTEST] in heads or "=" + word in places else ()
            if len(known) < _MEMORY:
                known[word] = at
        for place in at:
            found[place] += count
    return list(found), list(found.values()), total


def _matrix(rows: list[tuple[list[int], list[int], int]], width: int) -> np.ndarray:
    """log(1 + number) of each term, log of the words, a constant."""
    x = np.zeros((len(rows), width + 2))
    for i, (at, counts, total) in enumerate(rows):
        x[i, at] = np.log1p(counts)
        x[i, width] = np.log1p(total) / 5
    x[:, width + 1] = 1
    return x


def _probability(scores: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scores, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    weight, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, STEPS + 1):
        p = _probability(x @ weight)
        slope = x.T @ (y - p) / len(y) - PENALTY * weight
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        weight = weight + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return weight


def fit(x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Weights per category, and the out-of-fold log-odds of the first one."""
    weights, first = [], np.zeros(len(x))
    for c in range(y.shape[1]):
        outside = np.zeros(len(x))
        for f in range(FOLDS):
            held = folds == f
            if held.any() and not held.all():
                outside[held] = x[held] @ _logistic(x[~held], y[~held, c])
        weights.append(_logistic(x, y[:, c]))
        if c == 0:
            first = outside
        x = np.column_stack([x, _probability(outside)])
    return weights, first


def predict(x: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """Probability of each category, one after another."""
    out = []
    for weight in weights:
        scores = x @ weight
        out.append(_probability(scores))
        x = np.column_stack([x, out[-1]])
    return np.column_stack(out)


def _threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The lowest probability with the best F1 over out-of-fold predictions, half-way to the next lower one."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + max(1, y.sum()))
    best = len(f1) - 1 - int(np.argmax(f1[::-1]))
    edge = scores[order[best]] if best + 1 == len(y) else (scores[order[best]] + scores[order[best + 1]]) / 2
    return float(np.clip(_probability(edge), 0.05, 0.95))


def train(documents: DataFrame, labels: DataFrame, text: str = "text", most: int = TRAIN_DOCUMENTS, most_chars: int = TRAIN_CHARS,
          most_terms: int = TERMS) -> Chain | None:
    """Chain fitted on at most ``most`` labelled documents that are not held out, of at most ``most_chars`` characters
    each, one for each id; None if there are none or all have one label. Terms are those that tell the labels apart best over the sample;
    the driver gets ``most_terms`` of them and a row of their numbers per document of the sample."""
    named = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").alias("_d"), F.col("toxic").cast("int").alias("_y"), (F.coalesce(F.col("quality"), F.lit(1)) == 0).cast("int").alias("_q"),
                     F.xxhash64("doc_id").alias("_h")).distinct().orderBy("_h", "_d", "_y", "_q").limit(most))
    sample = materialise(sampled(small_batches(documents), named, text).where(
        F.coalesce(F.length("_t"), F.lit(0)) <= most_chars).select("_h", "_y", "_q", "_t"), "toxicity-sample")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = (Counter(), Counter())
            for y, found in batch.itertuples(index=False):
                seen[y].update({t for w in word_counts(found) for t in terms_of(w)})
            for y in (0, 1):
                yield pd.DataFrame({"term": list(seen[y]), "y": y, "n": list(seen[y].values())})

    sizes = {r["_y"]: r["n"] for r in sample.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    a, b, n1, n0 = F.col("a"), F.col("b"), sizes[1], sizes[0]
    share = (a + b + 1) / (n1 + n0 + 2)
    gain = a * F.log((a + 0.5) / (n1 + 1) / share) + b * F.log((b + 0.5) / (n0 + 1) / share)
    both = sample.select("_y", "_t").mapInPandas(counted, "term string, y int, n bigint").groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    chosen = both.where("a + b > 2").withColumn("_g", F.round(gain, 9)).orderBy(F.desc("_g"), "term").limit(most_terms).collect()
    places = {r["term"]: i for i, r in enumerate(chosen)}
    toxic_terms = [places[r["term"]] for r in chosen if r["a"] >= 5 and r["a"] >= 0.95 * (r["a"] + r["b"])]
    heads = frozenset(t[:_SHORTEST] for t in places if t[0] != "=")

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            found = [describe(t, places, heads, known) for t in batch["_t"]]
            yield pd.DataFrame({"h": batch["_h"], "y": batch["_y"], "q": batch["_q"], "at": [f[0] for f in found], "counts": [f[1] for f in found],
                                "words": [f[2] for f in found]})

    rows = sample.mapInPandas(described, "h bigint, y int, q int, at array<int>, counts array<bigint>, words bigint").toPandas()
    rows = rows.sort_values(["h", "y", "q", "words"], kind="stable")
    x = _matrix(list(zip(rows["at"], rows["counts"], rows["words"], strict=True)), len(places))
    toxic = rows["y"].to_numpy()
    rate = np.expm1(x[:, toxic_terms]).sum(axis=1) / np.maximum(rows["words"].to_numpy(), 1)
    severe = toxic * (rate >= max(np.median(rate[toxic == 1]), 1e-9))
    y = np.column_stack([toxic, severe, toxic * rows["q"].to_numpy()])
    weights, outside = fit(x, y.astype(float), (rows["h"].to_numpy() % FOLDS).astype(int))
    return Chain(places, weights, _threshold(outside, toxic), heads)


def probabilities(text: Column, chain: Chain | None) -> Column:
    @F.pandas_udf(", ".join(f"{c} double" for c in CATEGORIES))
    def of(texts: pd.Series) -> pd.DataFrame:
        if chain is None:
            return pd.DataFrame(np.zeros((len(texts), len(CATEGORIES))), columns=list(CATEGORIES))
        known: dict[str, tuple[int, ...]] = {}
        out = [np.zeros((0, len(CATEGORIES)))]
        for i in range(0, len(texts), 1000):
            rows = [describe(t, chain.places, chain.heads, known) for t in texts.iloc[i:i + 1000]]
            wordy = np.array([[float(words > 0)] for _, _, words in rows])
            out.append(predict(_matrix(rows, len(chain.places)), chain.weights) * wordy)
        return pd.DataFrame(np.concatenate(out), columns=list(CATEGORIES))
    return of(text)


def judged(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, p_toxic, p_severe, p_toxic_junk, toxic (1 if p_toxic reaches the threshold
    found on out-of-fold predictions).

    Null texts count as empty, and texts without words have probabilities of 0; without labels of both kinds all probabilities and verdicts are 0; null doc_ids are
    judged too; repeated rows get equal results; an empty table gives none; other columns are not read.
    """
    chain = train(documents, labels, text)
    found = documents.select("doc_id", probabilities(F.col(text).cast("string"), chain).alias("_p"))
    return found.select("doc_id", *[F.col(f"_p.{c}").alias(f"p_{c}") for c in CATEGORIES],
                        (F.col("_p.toxic") >= (chain.threshold if chain else 2.0)).cast("int").alias("toxic"))
