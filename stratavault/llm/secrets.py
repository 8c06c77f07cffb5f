"""Secret scanning with a character convolutional network.

Fixed patterns give findings that always stand. Every long token, and shorter ones after a telling word, that no finding of
the patterns holds whole is a candidate: a small convolutional network in numpy reads its characters and those around it. It
is trained on labelled findings: those of the patterns against the other candidates in a bounded sample of the corpus, and
generated ones of known kinds. The others of the corpus have no labels: those that look like findings after a first round
of training, which takes them for none, are left out of the second. The scores are calibrated on findings kept out of training, and the
threshold of each class of token is the highest that still finds the required share of the true ones among those that are
scored.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import sampled, small_batches

# The patterns, the least length of a finding, and the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "model")
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LONG = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LONG},}}")
#: Shorter tokens count after one of these words, from the length that the pattern of assignments takes.
TELLING = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|auth(?:orization)?|bearer|credentials?)["']?(?:\x20*+[:=]\x20*+|\x20++(?:is\x20++)?)"""
                     rf"""["']?(?=([A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST},{LONG}}}))""", re.IGNORECASE | re.ASCII)
CLASSES = ("hex", "alnum", "mixed")
#: Bound of the training sample: documents (those with the smallest hashes) and findings of one of them.
TRAIN_DOCUMENTS = 2000
TRAIN_FINDINGS = 20
GENERATED = 1500
RECALL = 0.95
BEFORE, HEAD, TAIL, AFTER = 32, 40, 8, 16
WINDOW = BEFORE + HEAD + TAIL + AFTER
#: Longer candidates are read in pieces of HEAD + TAIL characters, STRIDE apart, so 40 characters in a row meet in one piece.
STRIDE = 8
#: Windows of one token of the training sample; of a longer token, those at its finding or evenly spread ones.
TRAIN_WINDOWS = 16
EMBED, WIDTH, FILTERS = 8, 5, 24
EPOCHS, BATCH, RATE = 6, 128, 0.01


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns, leftmost and non-overlapping per kind, in order."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYS):  # the pattern cannot match without one of them
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    # a maximal run of 24 or more is the same as a run that is dropped unless it has 24
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Long tokens, and shorter ones after a telling word, in order, whatever the patterns say of them."""
    found = {m.end(): m.start() for m in CANDIDATE.finditer(text)}
    for m in TELLING.finditer(text):
        if len(m[1]) < LONG:
            found.setdefault(m.end(1), m.start(1))
    return sorted((start, end) for end, start in found.items())


def token_class(token: str) -> int:
    return 0 if all(c in "0123456789abcdef" for c in token) else 1 if token.isalnum() else 2


def window(text: str, start: int, end: int) -> bytes:
    """Characters before, the first and last ones of the candidate, and those after, each part in its place; others than
    ASCII count as one character."""
    head, tail = text[start:min(end, start + HEAD)], text[max(start + HEAD, end - TAIL):end]
    parts = (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0"), head.ljust(HEAD, "\0"), tail.rjust(TAIL, "\0"), text[end:end + AFTER].ljust(AFTER, "\0"))
    return "".join(parts).encode("ascii", "replace").replace(b"?", b"\x01")


def pieces(start: int, end: int) -> Iterator[tuple[int, int]]:
    """Overlapping pieces over the whole of a candidate; a short one is its only piece."""
    last = max(start, end - HEAD - TAIL)
    for at in range(start, last, STRIDE):
        yield at, at + HEAD + TAIL
    yield last, end


def sampled_pieces(start: int, end: int, covered: Covered) -> list[tuple[int, int]]:
    """At most TRAIN_WINDOWS of the pieces of a candidate: those that touch a finding, if there are any, evenly spread."""
    every = list(pieces(start, end))
    told = [p for p in every if covered.touches(*p)] or every
    return [told[i] for i in np.unique(np.linspace(0, len(told) - 1, min(len(told), TRAIN_WINDOWS)).astype(int))]


@dataclass
class Network:
    """Embedding, one convolution, maxima over the places before, in and after the candidate, one linear layer. A candidate
    of several windows has the highest of their scores."""
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    thresholds: tuple[float, ...] = (0.5, 0.5, 0.5)


#: Parts of the window over which maxima are taken; a place belongs to the part in which its convolution starts.
_PARTS = ((0, BEFORE), (BEFORE - 2, BEFORE + HEAD + TAIL - WIDTH + 1), (BEFORE + HEAD + TAIL - 2, WINDOW - WIDTH + 1))


def _forward(net: Network, windows: np.ndarray):
    vectors = net.embed[windows]
    columns = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH, axis=1).reshape(len(windows), WINDOW - WIDTH + 1, EMBED * WIDTH)
    hidden = np.maximum(columns @ net.kernel + net.bias, 0)
    places = [a + hidden[:, a:b].argmax(axis=1) for a, b in _PARTS]
    rows = np.arange(len(windows))[:, None]
    pooled = np.concatenate([hidden[rows, p, np.arange(FILTERS)] for p in places], axis=1)
    return columns, places, pooled, pooled @ net.out[:-1] + net.out[-1]


def raw_scores(net: Network, windows: np.ndarray) -> np.ndarray:
    return np.concatenate([_forward(net, windows[i:i + 512])[3] for i in range(0, len(windows), 512)] or [np.zeros(0)])


def probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(net.slope * raw_scores(net, windows) + net.offset, -30, 30)))


def _strongest(net: Network, windows: np.ndarray, starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The window with the highest score of each of some tokens; those of token i are starts[i] to starts[i + 1]."""
    rows, sizes = starts[at].copy(), starts[at + 1] - starts[at]
    several = np.flatnonzero(sizes > 1)
    if len(several):
        owners = np.repeat(several, sizes[several])
        every = np.concatenate([np.arange(starts[t], starts[t + 1]) for t in at[several]])
        order = np.lexsort((-raw_scores(net, windows[every]), owners))
        rows[several] = every[order[np.unique(owners[order], return_index=True)[1]]]
    return rows


def train(windows: np.ndarray, labels: np.ndarray, classes: np.ndarray, seed: int = 2, recall: float = RECALL, counts: np.ndarray | None = None,
          scored: np.ndarray | None = None, unsure: np.ndarray | None = None) -> Network:
    """Trained on two thirds of the findings; calibration and thresholds come from the rest. The seed fixes the result.
    ``counts`` are the numbers of windows of each finding, one of each if not given; the one with the highest score is learnt from.
    ``scored`` tells which findings the network will be asked for, all if not given; the thresholds rest on these.
    ``unsure`` tells which labels of 0 only mean that none is known: after a first round, findings among these that score like
    the better half of the true ones of their class are left out, and a second round starts from the network of the first."""
    rng = np.random.default_rng(seed)
    starts = np.concatenate([[0], np.cumsum(np.ones(len(labels), int) if counts is None else counts)])
    net = Network(rng.normal(0, 0.3, (128, EMBED)), rng.normal(0, 0.2, (EMBED * WIDTH, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, FILTERS * len(_PARTS) + 1))
    names = ("embed", "kernel", "bias", "out")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    order = rng.permutation(len(labels))
    kept, used, step = order[::3], np.setdiff1d(order, order[::3]), 0
    share = np.clip(labels[used].mean(), 0.05, 0.95)
    for epoch in range(EPOCHS if unsure is None else 2 * EPOCHS):
        if epoch == EPOCHS:
            guess = raw_scores(net, windows[_strongest(net, windows, starts, np.arange(len(labels)))])
            usual = np.array([np.median(guess[(classes == c) & (labels == 1)]) if ((classes == c) & (labels == 1)).any() else np.inf for c in range(len(CLASSES))])
            doubted = unsure & (guess >= usual[classes])
            used, kept = used[~doubted[used]], kept[~doubted[kept]]
        mixed = rng.permutation(used)
        for i in range(0, len(mixed), BATCH):
            at = mixed[i:i + BATCH]
            seen = windows[_strongest(net, windows, starts, at)]
            columns, places, pooled, scores = _forward(net, seen)
            weight = np.where(labels[at] == 1, 0.5 / share, 0.5 / (1 - share))
            error = weight * (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - labels[at]) / len(at)
            slopes = {"out": np.append(pooled.T @ error, error.sum()), "kernel": np.zeros_like(net.kernel), "bias": np.zeros_like(net.bias),
                      "embed": np.zeros_like(net.embed)}
            for p, place in enumerate(places):
                part = slice(p * FILTERS, (p + 1) * FILTERS)
                back = error[:, None] * net.out[part] * (pooled[:, part] > 0)
                picked = columns[np.arange(len(at))[:, None], place]
                slopes["kernel"] += np.einsum("nfk,nf->kf", picked, back)
                slopes["bias"] += back.sum(axis=0)
                down = (back[:, :, None] * net.kernel.T[None]).reshape(len(at), FILTERS, EMBED, WIDTH)
                for w in range(WIDTH):
                    np.add.at(slopes["embed"], seen[np.arange(len(at))[:, None], place + w], down[:, :, :, w])
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * slopes[n]
                second[n] = 0.999 * second[n] + 0.001 * slopes[n] ** 2
                setattr(net, n, getattr(net, n) - RATE * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8))
    strongest = windows[_strongest(net, windows, starts, kept)]
    scores, truth = raw_scores(net, strongest), labels[kept]
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(net.slope * scores + net.offset, -30, 30)))
        net.slope, net.offset = net.slope + 0.02 * ((truth - p) * scores).mean(), net.offset + 0.1 * (truth - p).mean()
    found = probabilities(net, strongest)
    asked, limits = (truth == 1) & (True if scored is None else scored[kept]), []
    for c in range(len(CLASSES)):
        true = np.sort(found[(classes[kept] == c) & asked])[::-1]
        limits.append(float(true[int(np.ceil(recall * len(true))) - 1]) if len(true) else 1.0)
    net.thresholds = tuple(limits)
    return net


def generated(count: int = GENERATED, seed: int = 1) -> list[tuple[str, int, int, int]]:
    """Invented findings (text, start, end, label): keys after telling words or with known heads, against identifiers,
    addresses, versions, times and numbers. A third stands inside a longer token, like a key among the folders of a path."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    chars = lambda alphabet, low, high: "".join(alphabet[i] for i in rng.integers(len(alphabet), size=int(rng.integers(low, high))))
    lower, digits = string.ascii_lowercase, string.digits
    mixed, hexes = string.ascii_letters + digits, "0123456789abcdef"
    words = lambda n: " ".join(chars(lower, 2, 9) for _ in range(n))
    folders = lambda n: "/".join(chars(lower, 2, 10) for _ in range(n))
    headed = lambda: pick(["ghp_", "xoxb-", "sk_live_", "glpat-", "AIza"]) + chars(mixed, 20, 40)
    out = []
    for i in range(count):
        true = i % 2
        if i % 6 > 3:  # both labels: within a path, of which only a part is told
            before = words(4) + " " + pick(["see ", "file ", "at ", "from "]) + f"{chars(lower, 3, 9)}.org/{folders(int(rng.integers(1, 12)))}/"
            token = headed() if true else pick([lambda: folders(5), lambda: f"{folders(3)}/{chars(digits, 2, 9)}", lambda: f"{chars(lower, 4, 9)}{chars(digits, 1, 5)}/{folders(3)}"])()
            after = pick(["", f"/{chars(lower, 3, 9)}.txt", f"/{folders(int(rng.integers(1, 8)))}"]) + " "
            out.append((before + token + after + words(3), len(before), len(before) + len(token), true))
            continue
        if true:  # each lead is a telling word
            lead = pick(["client_secret=", "auth: ", "Authorization: Bearer ", "private key ", "pwd=", "credential: ", "access_key ", "signing key: ", "secret is "])
            token = pick([lambda: chars(mixed, 24, 45), lambda: chars(hexes, 24, 65), lambda: chars(mixed + "+/", 30, 45) + "=",
                          lambda: chars(mixed, 8, 16), lambda: chars(hexes, 12, 24), lambda: chars(string.ascii_letters, 20, 41), lambda: headed()[:8] + chars(hexes, 24, 41),
                          headed])()
        else:
            lead = pick(["see ", "id ", "http://", "file ", "at ", "version ", "ref ", "from ", "key ", "token is ", "auth: "])
            token = pick([lambda: chars(lower, 6, 16), lambda: "-".join(chars(lower, 3, 9) for _ in range(4)), lambda: chars("-", 1, 2) * int(rng.integers(16, 80)),
                          lambda: chars(lower, 16, 24), lambda: f"www.{chars(lower, 5, 12)}.org/{folders(2)}", lambda: f"{chars(digits, 2, 5)}.{chars(digits, 1, 4)}",
                          lambda: "-".join(chars(hexes, n, n + 1) for n in (8, 4, 4, 4, 12)), lambda: f"www.{chars(lower, 5, 12)}.org/{chars(lower, 3, 8)}/{chars(digits, 2, 6)}",
                          lambda: f"{chars(lower, 4, 9)}_{chars(lower, 4, 9)}_{chars(digits, 1, 4)}.txt", lambda: chars(digits, 16, 24),
                          lambda: f"2024-0{chars(digits, 1, 2)}-1{chars(digits, 1, 2)}T0{chars(digits, 1, 2)}.00.00.000", lambda: ".".join(chars(digits, 1, 5) for _ in range(6)) + ".0000"])()
        before = words(4) + " " + lead
        out.append((before + token + " " + words(3), len(before), len(before) + len(token), true))
    return [(text, start, end, label) for text, start, end, label in out if any(s < end and e > start for s, e in candidates(text))]


class Covered:
    """The union of some spans, asked whether another one touches it."""

    def __init__(self, spans: list[tuple[int, int, int]]) -> None:
        self.starts, self.ends = [], []
        for start, _, end in spans:
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and self.ends[at] >= end


def network(documents: DataFrame, text: str = "text", most: int = TRAIN_DOCUMENTS, most_findings: int = TRAIN_FINDINGS) -> Network:
    """Trained on the generated findings and those of at most ``most`` documents (one for each id), ``most_findings`` of each; the windows of
    these, TRAIN_WINDOWS of each at most, are all that reaches the driver."""
    named = documents.select(F.col("doc_id").alias("_d"), F.xxhash64("doc_id").alias("_h")).where("_d IS NOT NULL").distinct().orderBy("_h", "_d").limit(most)

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for mark, found in batch.itertuples(index=False):
                covered = Covered(base_spans(found or ""))
                for n, (start, end) in enumerate(candidates(found or "")):
                    if n == most_findings:
                        break
                    shown = [window(found, a, b) for a, b in sampled_pieces(start, end, covered)]
                    rows.append((mark, n, b"".join(shown), token_class(found[start:end]), int(covered.touches(start, end)),
                                 not covered.holds(start, end)))
            yield pd.DataFrame(rows, columns=["mark", "place", "windows", "kind", "label", "scored"])

    sample = sampled(small_batches(documents), named, text).select(F.xxhash64("doc_id", "_t").alias("_mark"), "_t")
    rows = sample.mapInPandas(labelled, "mark bigint, place int, windows binary, kind int, label int, scored boolean").toPandas().sort_values(["mark", "place"], kind="stable")
    made = generated()
    whole = [next((a, b) for a, b in candidates(t) if a < e and b > s) for t, s, e, _ in made]
    told = [Covered([(s, 0, e)] if y else []) for _, s, e, y in made]
    windows = [bytes(w) for w in rows["windows"]] + [b"".join(window(m[0], a, b) for a, b in sampled_pieces(*at, c)) for m, at, c in zip(made, whole, told, strict=True)]
    labels = np.append(rows["label"].to_numpy(int), [y for *_, y in made])
    classes = np.append(rows["kind"].to_numpy(int), [token_class(m[0][slice(*at)]) for m, at in zip(made, whole, strict=True)])
    scored = np.append(rows["scored"].to_numpy(bool), [not Covered(base_spans(m[0])).holds(*at) for m, at in zip(made, whole, strict=True)])
    every, counts = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW), np.array([len(w) // WINDOW for w in windows])
    return train(every, labels, classes, counts=counts, scored=scored, unsure=(labels == 0) & (np.arange(len(labels)) < len(rows)))


def spans_of(texts: list[str | None], net: Network) -> list[tuple[list, list]]:
    """Findings of each text: those of the patterns, and all in order. The network sees the whole of each candidate but those
    that lie within a finding of the patterns; windows are scored in blocks, so one text with very many or very long ones needs no more memory."""
    out = []
    for text in texts:
        base = base_spans(text or "")
        covered = Covered(base)
        tokens = [(s, e) for s, e in candidates(text or "") if not covered.holds(s, e)]
        best, held, owners = np.zeros(len(tokens)), [], []

        def scored() -> None:
            if held:
                np.maximum.at(best, owners, probabilities(net, np.array([np.frombuffer(w, np.uint8) for w in held])))  # noqa: B023
                held.clear()  # noqa: B023
                owners.clear()  # noqa: B023

        for n, (start, end) in enumerate(tokens):
            for a, b in pieces(start, end):
                held.append(window(text, a, b))
                owners.append(n)
                if len(held) == 512:
                    scored()
        scored()
        more = [(s, 3, e) for (s, e), p in zip(tokens, best, strict=True) if p >= net.thresholds[token_class(text[s:e])]]
        out.append((base, sorted(base + more)))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def findings(text: Column, net: Network) -> Column:
    """n_assign, n_access, n_hex, base and spans: findings as kind:start:end, in code points, end exclusive."""
    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base string, spans string")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, every in spans_of(list(texts), net):
            kinds = [k for _, k, _ in base]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), _joined(base), _joined(every)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])
    return of(text)


def scanned(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null texts count as empty, which have no findings; null doc_ids and repeated rows are scanned like any other; an
    empty table gives none; other columns are not read.
    """
    found = documents.select("doc_id", findings(F.col(text).cast("string"), network(documents, text)).alias("_f"))
    return found.select("doc_id", "_f.n_assign", "_f.n_access", "_f.n_hex", F.sha2("_f.base", 256).alias("base_sha256"), "_f.spans")
