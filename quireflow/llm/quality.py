"""Quality classifier (operator 1): an additive model with pairwise interactions.

Each feature of a text is binned by quantiles of the training sample.  Shallow
trees of one feature are boosted in turn over all features (cyclic boosting)
and each adds to that feature's lookup table; then the pairs of features that
explain most of what is left get tables of their own.  A score is the logistic
of the sum of the looked-up values.

Defined results: a null text is scored as an empty one; with no training rows,
or rows of one class only, every score is the (smoothed) share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm import sample
from quireflow.llm.common import WordHashes, chunks, crc_split, ngram_hashes, small_batches

#: Labelled rows learned from, in expectation.
SAMPLE_ROWS = 12_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 80, 0.15
NAMES = ["log_chars", "upper", "digit", "space", "stop", "mark", "symbol", "word_chars", "log_words", "distinct_words", "distinct_trigrams", "same_as_before", "line_chars", "distinct_lines", "odd_ends"]


@cache
def _classes() -> np.ndarray:
    """Class of a code point: 0 symbol, 1 lower or other letter, 2 upper letter, 3 digit, 4 space, 5 stop, 6 mark."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        out[cp] = 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 0
    for c in ".,;:'\"()-":
        out[ord(c)] = 5
    for c in "!?":
        out[ord(c)] = 6
    return out


class Features:
    """The feature matrix of texts."""

    def __init__(self):
        self.classes = _classes()
        self.hashes = WordHashes(most=200_000)

    def one(self, text: str) -> list[float]:
        points = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        n = max(len(points), 1)
        symbol, lower, upper, digit, space, stop, mark = np.bincount(points, minlength=7)[:7]
        words = text.encode("utf-8", "surrogatepass").split()
        w = max(len(words), 1)
        h = self.hashes(words)
        grams = ngram_hashes(h, 3)
        lines = [x for x in text.split("\n") if x]
        ends = np.array([x[-1] for x in words] or [0], np.uint8)  # 33..47 without ',' and '.', and the like
        odd = ((ends < 48) & (ends != 44) & (ends != 46)) | ((ends > 57) & (ends < 65)) | ((ends > 90) & (ends < 97)) | ((ends > 122) & (ends < 128))
        return [
            np.log1p(len(points)), upper / max(lower + upper, 1), digit / n, space / n, stop / n, mark / n, symbol / n,
            sum(map(len, words)) / w, np.log1p(len(words)), len(set(words)) / w, len(np.unique(grams)) / max(len(grams), 1),
            float((h[1:] == h[:-1]).sum()) / w, len(points) / max(len(lines), 1), len(set(lines)) / max(len(lines), 1), odd.sum() / w,
        ]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.one(t or "") for t in texts], np.float32).reshape(len(texts), len(NAMES))


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, base: float, edges: list[np.ndarray], coarse: list[np.ndarray]):
        self.base, self.edges, self.coarse = base, edges, coarse
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], 1)

    def pair_bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.coarse)], 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        bins, coarse = self.bins(x), self.pair_bins(x)
        out = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            out += t[bins[:, f]]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[coarse[:, a], coarse[:, b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Best-first tree over the bins of one feature: the value of each bin."""
    parts, cg, ch = [(0, len(g))], np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, lo
        at = np.arange(lo + 1, hi)
        lg, lh, tg, th = cg[at] - cg[lo], ch[at] - ch[lo], cg[hi] - cg[lo], ch[hi] - ch[lo]
        gain = _gain(lg, lh) + _gain(tg - lg, th - lh) - _gain(tg, th)
        gain[(lh < 2) | (th - lh < 2)] = 0
        k = int(gain.argmax())
        return float(gain[k]), int(at[k])

    while len(parts) < leaves:
        (gain, cut), k = max((best(*p), i) for i, p in enumerate(parts))
        if gain <= 1e-9:
            break
        lo, hi = parts[k]
        parts[k : k + 1] = [(lo, cut), (cut, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = (cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + 1.0)
    return out


def cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """One cut on each axis of a pair: gain of the best four quadrants and the value of each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a = (cg[:-1, :-1], ch[:-1, :-1])
    b = (cg[:-1, -1:] - a[0], ch[:-1, -1:] - a[1])
    c = (cg[-1:, :-1] - a[0], ch[-1:, :-1] - a[1])
    d = (tg - a[0] - b[0] - c[0], th - a[1] - b[1] - c[1])
    gain = sum(_gain(*q) for q in (a, b, c, d)) - _gain(tg, th)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for q, rows, cols in ((a, slice(None, i + 1), slice(None, j + 1)), (b, slice(None, i + 1), slice(j + 1, None)), (c, slice(i + 1, None), slice(None, j + 1)), (d, slice(i + 1, None), slice(j + 1, None))):
        out[rows, cols] = q[0][i, j] / (q[1][i, j] + 1.0)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of the features' tables, then of the tables of the strongest pairs."""
    share = (y.sum() + 1) / (len(y) + 2)
    cut = lambda k: [np.unique(np.quantile(x[:, f], np.linspace(0, 1, k + 1)[1:-1])) if len(x) else np.empty(0) for f in range(len(NAMES))]
    model = AdditiveModel(float(np.log(share / (1 - share))), cut(BINS), cut(PAIR_BINS))
    if len(set(y.tolist())) < 2:
        return model
    bins, coarse = model.bins(x), model.pair_bins(x)
    logit = np.full(len(y), model.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, t in enumerate(model.tables):
            g, h = residual()
            k = bins[:, f]
            step = RATE * shallow_tree(np.bincount(k, g, len(t)), np.bincount(k, h, len(t)))
            t += step
            logit += step[k]
    sides = [len(e) + 1 for e in model.coarse]

    def histograms(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, shape = coarse[:, a] * sides[b] + coarse[:, b], (sides[a], sides[b])
        return np.bincount(k, g, shape[0] * shape[1]).reshape(shape), np.bincount(k, h, shape[0] * shape[1]).reshape(shape)

    g, h = residual()
    able = [p for p in combinations(range(len(NAMES)), 2) if sides[p[0]] > 1 and sides[p[1]] > 1]
    model.pairs = sorted(able, key=lambda p: -cross_tree(*histograms(*p, g, h))[0])[:PAIRS]
    model.pair_tables = [np.zeros((sides[a], sides[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), t in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * cross_tree(*histograms(a, b, *residual()))[1]
            t += step
            logit += step[coarse[:, a], coarse[:, b]]
    return model


def feature_rows(texts: DataFrame) -> DataFrame:
    """y and the features of each sampled row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in chunks(batches):
            x = features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float32()))], ["y", "x"])

    return texts.select("y", "text").mapInArrow(run, "y int, x array<float>")


def train(docs: DataFrame, labels: DataFrame, trainable: F.Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> AdditiveModel:
    small_batches(docs.sparkSession)
    ids = sample.labelled(labels, label, trainable, rows)
    got = feature_rows(sample.with_text(docs, ids)).collect() if ids else []
    got.sort(key=lambda r: (r.y, list(r.x)))
    return fit(np.array([r.x for r in got], np.float32).reshape(len(got), len(NAMES)), np.array([r.y > 0 for r in got], np.float64))


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score of each row's text: one map over the scan, no shuffle."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, tables = Features(), shipped.value
        for batch in chunks(batches):
            s = tables.score(features(batch.column(1).to_pylist())).round(6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, learned from labelled rows that are not held out."""
    out = score(docs, train(docs, labels, ~crc_split(F.col("doc_id"), modulus, held)))
    return out.select("doc_id", crc_split(F.col("doc_id"), modulus, held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
