"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own surface features and those of its two neighbours, and from the labels
beside it. Forward-backward gives the probability that a line is good; the length-weighted mean of these, on the
log-odds scale and calibrated on the training documents, is the quality of the document. Lines have no labels of their
own: in training they all carry that of their document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import sampled, small_batches

#: Bound of the training sample: labelled documents (those with the smallest hashes), and lines of one of them.
TRAIN_DOCUMENTS = 3000
TRAIN_LINES = 256
STEPS = 100
RATE = 0.1
PENALTY = 1e-3
#: Bytes that are looked at together; longer lines are summed up in pieces.
PIECE = 1 << 19

_CLASSES = ("letter", "upper", "digit", "stop", "pause", "mark", "bar", "rest")
_CLASS = np.full(256, _CLASSES.index("letter"), np.uint8)
for _chars, _name in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"), (b"0123456789", "digit"), (b".!?", "stop"), (b",;:'\"()-", "pause"),
                      (b"#$%&*@^~=+<>{}[]_\\/`", "mark"), (b"|", "bar"), (bytes(range(33)), "rest")):
    _CLASS[list(_chars)] = _CLASSES.index(_name)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Per line: bytes, words, words equal to the one before, words equal to the one two before, long words, classes.
_SUMS = 5 + len(_CLASSES)
FEATURES = 14


def _line_sums(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sums per line of ``data`` (ends with a line feed), and the place of each line's end."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw == 10)
    sums = np.zeros((len(ends), _SUMS))
    done = 0
    while done < len(raw):
        stop = min(len(raw), done + PIECE)
        if stop < len(raw):  # up to the last blank, if there is one
            back = np.flatnonzero(_BLANK[raw[done:stop]])
            stop = done + int(back[-1]) + 1 if len(back) else stop
        part = raw[done:stop]
        feeds = part == 10
        line = np.searchsorted(ends, done) + np.cumsum(feeds) - feeds
        kinds = _CLASS[part]
        sums += np.bincount(line * len(_CLASSES) + kinds, minlength=len(ends) * len(_CLASSES)).reshape(-1, len(_CLASSES)) @ _PLACE
        sums[:, 0] += np.bincount(line, minlength=len(ends))
        inside = ~_BLANK[part]
        starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
        if len(starts):
            finish = np.flatnonzero(inside & np.concatenate((~inside[1:], [True]))) + 1
            place = np.arange(len(part)) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(part)]))))
            weighed = np.where(inside, (part.astype(np.uint64) + np.uint64(1)) * _MIX[place & 63], np.uint64(0))
            hashes = np.add.reduceat(weighed, starts)
            of = line[starts]
            sums[:, 1] += np.bincount(of, minlength=len(ends))
            for back, column in ((1, 2), (2, 3)):
                same = (hashes[back:] == hashes[:-back]) & (of[back:] == of[:-back])
                sums[:, column] += np.bincount(of[back:][same], minlength=len(ends))
            sums[:, 4] += np.bincount(of[finish - starts > 9], minlength=len(ends))
        done = stop
    return sums, ends


_PLACE = np.zeros((len(_CLASSES), _SUMS))
_PLACE[np.arange(len(_CLASSES)), np.arange(5, _SUMS)] = 1
_MIX = (np.random.default_rng(8).integers(1 << 62, size=64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of some texts, the bytes of each line, and the number of lines of each text."""
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sums, ends = _line_sums(b"\n".join(blobs) + b"\n")
    of = np.searchsorted(np.cumsum([len(b) + 1 for b in blobs]), ends, side="right")
    size, count = np.maximum(sums[:, 0] - 1, 0), sums[:, 1]
    per_byte = sums[:, 5:] / np.maximum(sums[:, :1], 1)
    per_word = sums[:, 2:5] / np.maximum(count[:, None], 1)
    mean = size / np.maximum(count, 1)
    own = np.column_stack([per_byte, per_word, np.log1p(size) / 5, np.minimum(mean, 40) / 10, count == 0])
    return own, size, np.bincount(of, minlength=len(blobs))


def with_neighbours(own: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after in the same text (zeros at its ends), and a constant."""
    first = np.zeros(len(own), bool)
    first[np.concatenate(([0], np.cumsum(lines)[:-1]))[lines > 0]] = True
    last = np.roll(first, -1)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first] = 0
    after[last] = 0
    return np.column_stack([own, before, after, np.ones(len(own))])


@dataclass(frozen=True)
class Field:
    """A fitted random field: standardisation, weights, transitions and the calibration of the document score."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float


def marginals(scores: np.ndarray, lines: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for every line, and sums of the probabilities of neighbouring pairs, by forward-backward.

    ``scores`` are the log-odds of the lines one after another, ``lines`` their number per text. All texts that still
    have a line take each step together.
    """
    order = np.argsort(-lines, kind="stable")
    starts = (np.cumsum(lines) - lines)[order]
    ordered = lines[order]
    longest = int(ordered[0]) if len(ordered) else 0
    still = len(ordered) - np.searchsorted(ordered[::-1], np.arange(longest), side="right")
    emission = np.column_stack([np.zeros(len(scores)), scores])
    forward, backward = np.zeros((len(scores), 2)), np.zeros((len(scores), 2))
    total = np.zeros(len(lines))
    for t in range(longest):
        rows = starts[:still[t]] + t
        if t:
            step = forward[rows - 1][:, :, None] + moves[None]
            forward[rows] = np.logaddexp(step[:, 0], step[:, 1]) + emission[rows]
        else:
            forward[rows] = emission[rows]
    ends = starts[ordered > 0] + ordered[ordered > 0] - 1
    total[order[ordered > 0]] = np.logaddexp(forward[ends, 0], forward[ends, 1])
    spread = np.repeat(total, lines)
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        rows = starts[:still[t + 1]] + t
        step = moves[None] + (emission[rows + 1] + backward[rows + 1])[:, None, :]
        backward[rows] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        pairs += np.exp(forward[rows][:, :, None] + step - spread[rows][:, None, None]).sum(axis=0)
    return np.exp(forward[:, 1] + backward[:, 1] - spread), pairs


def _evidence(good: np.ndarray, size: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Length-weighted mean over the lines of each text, as log-odds."""
    weights = size + 1.0
    of = np.repeat(np.arange(len(lines)), lines)
    mean = np.bincount(of, good * weights, minlength=len(lines)) / np.maximum(np.bincount(of, weights, minlength=len(lines)), 1e-9)
    clipped = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(clipped / (1 - clipped))


def fit(own: np.ndarray, size: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> Field:
    """Maximum likelihood with a small penalty; full-batch steps from zero, so the same sample gives the same field."""
    features = with_neighbours(own, lines)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale < 1e-9] = 1.0
    mean[-1], scale[-1] = 0.0, 1.0
    x = (features - mean) / scale
    y = np.repeat(labels.astype(float), lines)
    pair_labels = np.bincount(labels, np.maximum(lines - 1, 0), minlength=2)
    weight = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, STEPS + 1):
        good, pairs = marginals(x @ weight[:-4], lines, weight[-4:].reshape(2, 2))
        grown = np.append(x.T @ (y - good), (np.diag(pair_labels) - pairs).ravel()) / len(lines) - PENALTY * weight
        first, second = 0.9 * first + 0.1 * grown, 0.999 * second + 0.001 * grown ** 2
        weight = weight + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    moves = weight[-4:].reshape(2, 2)
    log_odds, slope, offset = _evidence(marginals(x @ weight[:-4], lines, moves)[0], size, lines), 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * log_odds + offset, -30, 30)))
        slope, offset = slope + 0.05 * (((labels - p) * log_odds).mean() - 0.01 * (slope - 1)), offset + 0.05 * (labels - p).mean()
    return Field(mean, scale, weight[:-4], moves, max(slope, 0.05), offset)


def score(texts: list[str | None], field: Field | None) -> np.ndarray:
    """Probability that each text is good; 0.5 without a field."""
    if field is None or not len(texts):
        return np.full(len(texts), 0.5)
    own, size, lines = line_features(texts)
    good = marginals((with_neighbours(own, lines) - field.mean) / field.scale @ field.weights, lines, field.moves)[0]
    return 1 / (1 + np.exp(-np.clip(field.slope * _evidence(good, size, lines) + field.offset, -30, 30)))


def _in_pieces(texts: pd.Series) -> Iterator[list[str | None]]:
    """Neighbouring texts of about PIECE characters together, a longer one alone."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "") + 1
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def held_out(key: Column) -> Column:
    """Documents whose labels are not learnt from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, text: str = "text", most: int = TRAIN_DOCUMENTS, most_lines: int = TRAIN_LINES) -> Field | None:
    """Field fitted on at most ``most`` labelled documents that are not held out, of at most ``most_lines`` lines each; None
    if there are none. An id that repeats counts once, so features of ``most * most_lines`` lines at most reach the driver."""
    named = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").alias("_d"), F.col("quality").cast("int").alias("_y"), F.xxhash64("doc_id").alias("_h"))
             .distinct().orderBy("_h", "_d", "_y").limit(most))

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for mark, y, found in batch.itertuples(index=False):
                if (found or "").count("\n") < most_lines:
                    own, size, lines = line_features([found])
                    yield pd.DataFrame({"mark": [mark], "y": [y], "own": [own.ravel()], "size": [size], "lines": lines})

    sample = sampled(small_batches(documents), named, text).select(F.xxhash64("doc_id", "_t").alias("_mark"), "_y", "_t")
    rows = sample.mapInPandas(described, "mark bigint, y int, own array<double>, size array<double>, lines bigint").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["mark", "y"], kind="stable")
    return fit(np.concatenate(rows["own"].to_list()).reshape(-1, FEATURES), np.concatenate(rows["size"].to_list()),
               rows["lines"].to_numpy(), rows["y"].to_numpy())


def scores(text: Column, field: Field | None) -> Column:
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([score(some, field) for some in _in_pieces(texts)] or [np.zeros(0)]), dtype="float64")
    return of(text)


def judged(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, score, predicted (1 if the score is 0.5 or more).

    Null texts count as empty, which is one line without words; without any label to learn from every score is 0.5.
    Null doc_ids are scored and not held out; repeated rows get equal scores; an empty table gives none; other columns,
    and the labels of a scored document, are never part of a score.
    """
    found = scores(F.col(text).cast("string"), train(documents, labels, text))
    return documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def good_only(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without those predicted to be bad. All columns and all other rows stay; nothing is shuffled."""
    return documents.where(scores(F.col(text).cast("string"), train(documents, labels, text)) >= 0.5)
