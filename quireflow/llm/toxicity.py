"""Toxicity (operator 4): a bidirectional gated recurrent network with attention pooling.

A word enters as its own vector (known words) joined with the mean vector of
its character 4-grams (hashed).  Windows of words are read in both directions,
states are pooled by attention, and a document's score is that of its worst
window; windows start every STRIDE words to the text's end.  Training is plain numpy:
first every window takes its document's label, then only the worst windows do.
Windows to learn from are drawn on the executors, so the driver gets a bounded
number of words; scores are calibrated on the worst of all windows of the
sampled rows, as texts are scored.

Defined results: a null text is scored as an empty one, which is a window of
padding alone; with no training rows, or rows of one class only, every score is
the (smoothed) share of label 1.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm import sample
from quireflow.llm.common import chunks, crc_split, materialize, small_batches

#: Labelled rows learned from by class, in expectation; windows of a row that are learned from, by class, drawn by chance
#: where a text has more; windows of a row that training takes at first.
SAMPLE_ROWS = {0: 4000, 1: 1500}
TRAIN_WINDOWS = {0: 24, 1: 1000}
FIRST_WINDOWS = 6
WINDOW, STRIDE = 32, 24
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 8
VOCABULARY, GRAMS = 4000, 8192
EPOCHS_ALL, EPOCHS_WORST, BATCH, RATE = 2, 8, 256, 0.02
#: Share of word vectors left out in training (their characters remain), and decay of the vectors of grams.
WORD_DROPOUT, GRAM_DECAY = 0.5, 0.02
#: Weight of label 0 against 1 when scores are calibrated.
CLEAN_WEIGHT = 2.0
BLOCK, KNOWN_WORDS = 2048, 120_000
SEED = 20260103
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams_of(word: str) -> list[int]:
    s = f"<{word}>"
    return [zlib.crc32(s[i : i + 4].encode("utf-8", "surrogatepass")) % GRAMS for i in range(max(1, len(s) - 3))]


def window_starts(n: int) -> list[int]:
    """Starts of overlapping windows that cover n words."""
    if n <= WINDOW:
        return [0]
    out = list(range(0, n - WINDOW, STRIDE))
    return [*out, n - WINDOW]


class Network:
    """Parameters by name; both directions are stacked on the first axis."""

    def __init__(self, vocabulary: list[str], base: float):
        rng = np.random.default_rng(SEED)
        d = WORD_DIM + CHAR_DIM
        n = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.ids = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.base, self.slope, self.offset = base, 1.0, 0.0
        self.p = {
            "word": n(len(vocabulary) + 1, WORD_DIM, scale=0.3), "gram": n(GRAMS, CHAR_DIM, scale=0.5),
            "wx": n(2, d, 3 * HIDDEN, scale=d**-0.5), "wh": n(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "att": n(2 * HIDDEN, scale=0.3), "out": n(2 * HIDDEN, scale=0.3), "bias": np.full(1, base, np.float32),
        }
        self.p["word"][0] = 0

    # -- words ---------------------------------------------------------------
    def inputs(self, words: list[str], dropped: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of words, and what their gradient needs: word ids, flat grams, owners, lengths."""
        ids = np.array([self.ids.get(w, 0) for w in words], np.int64)
        if dropped is not None:
            ids[dropped] = 0
        grams = [grams_of(w) for w in words]
        sizes = np.array([len(g) for g in grams], np.int64)
        flat = np.array([x for g in grams for x in g], np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = np.add.reduceat(self.p["gram"][flat], starts, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][ids], mean], 1), ids, flat, owner, sizes

    def projected(self, x: np.ndarray) -> np.ndarray:
        return x @ self.p["wx"] + self.p["b"]  # 2, words, 3H

    # -- windows -------------------------------------------------------------
    @staticmethod
    def both(index: np.ndarray, words: int) -> np.ndarray:
        """Row numbers in the stacked table, forwards and backwards."""
        return np.stack([index, index[:, ::-1] + words])

    def run(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows.  table: 2, words, 3H; index: windows x WINDOW; mask: the same, True on words."""
        h_ = HIDDEN
        scale = np.float32(0.5)
        flat = table.reshape(-1, 3 * h_)
        at = self.both(index, table.shape[1])
        on = np.stack([mask, mask[:, ::-1]]).astype(np.float32)
        full = bool(mask.all())
        wh = self.p["wh"]
        n, steps = index.shape
        h = np.zeros((2, n, h_), np.float32)
        states = np.empty((2, n, steps, h_), np.float32)
        past = []
        for t in range(steps):
            a = flat[at[:, :, t]]
            u = h @ wh
            gates = a[..., : 2 * h_] + u[..., : 2 * h_]
            gates *= scale
            np.tanh(gates, out=gates)
            gates *= scale
            gates += scale
            z, r = gates[..., :h_], gates[..., h_:]
            c = np.tanh(a[..., 2 * h_ :] + r * u[..., 2 * h_ :])
            new = c + z * (h - c)
            if not full:
                new = h + (new - h) * on[:, :, t, None]
            if keep:
                past.append((h, u[..., 2 * h_ :], z, r, c))
            h = new
            states[:, :, t] = h
        seq = np.concatenate([states[0], states[1][:, ::-1]], 2)
        e = seq @ self.p["att"]
        e = np.where(mask, e, np.float32(-1e9))
        e -= e.max(1, keepdims=True)
        w = np.exp(e)
        w /= w.sum(1, keepdims=True)
        pooled = np.matmul(w[:, None, :], seq)[:, 0]
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (at, on, seq, w, pooled, past)) if keep else logit

    def gradients(self, words: list[str], index: np.ndarray, mask: np.ndarray, y: np.ndarray, dropped: np.ndarray) -> dict[str, np.ndarray]:
        """Mean log-loss gradients over windows, by back-propagation through time."""
        h_, p = HIDDEN, self.p
        x, ids, flat, owner, sizes = self.inputs(words, dropped)
        table = self.projected(x)
        logit, (at, on, seq, w, pooled, past) = self.run(table, index, mask, keep=True)
        d = ((1 / (1 + np.exp(-logit))) - y).astype(np.float32) / len(y)
        g = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * p["out"]
        d_w = np.matmul(seq, d_pooled[:, :, None])[..., 0]
        d_e = w * (d_w - (w * d_w).sum(1, keepdims=True))
        g["att"] = np.einsum("nth,nt->h", seq, d_e)
        d_seq = w[..., None] * d_pooled[:, None] + d_e[..., None] * p["att"]
        d_states = np.stack([d_seq[..., :h_], d_seq[:, ::-1, h_:]])
        d_table = np.zeros((table.shape[0] * table.shape[1], 3 * h_), np.float32)
        g["wh"] = np.zeros_like(p["wh"])
        d_h = np.zeros_like(past[0][0])
        for t in range(index.shape[1] - 1, -1, -1):
            h, uc, z, r, c = past[t]
            d_new = d_h + d_states[:, :, t]
            m = on[:, :, t, None]
            d_h = d_new * (1 - m)
            d_new = d_new * m
            d_z = d_new * (h - c) * z * (1 - z)
            d_c = d_new * (1 - z) * (1 - c * c)
            d_r = d_c * uc * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_c], 2)
            d_u = np.concatenate([d_z, d_r, d_c * r], 2)
            g["wh"] += np.matmul(h.transpose(0, 2, 1), d_u)
            d_h += d_new * z + np.matmul(d_u, p["wh"].transpose(0, 2, 1))
            np.add.at(d_table, at[:, :, t].ravel(), d_a.reshape(-1, 3 * h_))
        d_table = d_table.reshape(table.shape)
        g["b"] = d_table.sum(1, keepdims=True)
        g["wx"] = np.matmul(x.T[None], d_table)
        d_x = np.matmul(d_table, p["wx"].transpose(0, 2, 1)).sum(0)
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], ids, d_x[:, :WORD_DIM])
        g["word"][0] = 0
        g["gram"] = np.zeros_like(p["gram"])
        np.add.at(g["gram"], flat, (d_x[:, WORD_DIM:] / sizes[:, None].astype(np.float32))[owner])
        return g


class Scorer:
    """Scores whole texts; remembers the projected inputs of the words met."""

    def __init__(self, net: Network):
        self.net = net
        self._reset()

    def _reset(self) -> None:
        self.at = {"": 0}
        self.table = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def _learn(self, words: set[str]) -> None:
        new = sorted(words.difference(self.at))
        if not new:
            return
        if len(self.at) + len(new) > KNOWN_WORDS and len(self.at) > 1:
            self._reset()
            new = sorted(words.difference(self.at))
        lo, hi = len(self.at), len(self.at) + len(new)
        if hi > self.table.shape[1]:
            grown = np.zeros((2, max(hi, 2 * self.table.shape[1]), 3 * HIDDEN), np.float32)
            grown[:, :lo] = self.table[:, :lo]
            self.table = grown
        self.table[:, lo:hi] = self.net.projected(self.net.inputs(new)[0])
        self.at.update(zip(new, range(lo, hi), strict=True))

    def windows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index and mask of all windows of the texts, and the text of each window."""
        self._learn(set().union(*texts))
        index, owner = [], []
        for k, words in enumerate(texts):
            row = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
            if len(row) < WINDOW:
                row = np.concatenate([row, np.zeros(WINDOW - len(row), np.int64)])
            starts = np.array(window_starts(len(words)))
            index.append(row[starts[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(starts), k))
        index = np.concatenate(index)
        return index, index > 0, np.concatenate(owner)

    def logits(self, index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        out = np.empty(len(index), np.float32)
        for lo in range(0, len(index), BLOCK):
            out[lo : lo + BLOCK] = self.net.run(self.table, index[lo : lo + BLOCK], mask[lo : lo + BLOCK])
        return out

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """Logit of the worst window of each text."""
        got = [words_of(t) for t in texts]
        worst = np.full(len(got), -np.inf, np.float32)
        if got:
            index, mask, owner = self.windows(got)
            np.maximum.at(worst, owner, self.logits(index, mask))
        return worst

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.net.slope * self.worst(texts).astype(np.float64) + self.net.offset, -30, 30)))


class Adam:
    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.t = p, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            self.p[k] -= (rate / (1 - 0.9**self.t)) * self.m[k] / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-7)


def calibrate(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of labels on documents' worst logits, slightly smoothed."""
    w = np.where(y > 0, 1.0, CLEAN_WEIGHT)
    x = np.stack([logit, np.ones_like(logit)], 1)
    target = np.where(y > 0, 0.995, 0.002)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.linalg.solve(hess, x.T @ (w * (target - p)) - 1e-3 * (beta - [1.0, 0.0]))
        beta = beta + np.clip(step, -0.5, 0.5)
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def drawn_windows(text: str | None, label: int, seed: int) -> list[str]:
    """Windows of a text to learn from, as words with spaces."""
    words = words_of(text)
    starts, most = window_starts(len(words)), TRAIN_WINDOWS[label]
    if len(starts) > most:
        starts = sorted(np.random.default_rng(seed).choice(starts, most, replace=False))
    return [" ".join(words[s : s + WINDOW]) for s in starts]


def fit(windows: list[list[str]], labels: list[int]) -> Network:
    """Train on the windows of documents with one label each; uncalibrated."""
    y = np.array(labels, np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    parts = [w.split() for own in windows for w in own]
    of = np.repeat(np.arange(len(windows)), [len(own) for own in windows])
    seen = Counter(w for own in windows for w in {x for part in own for x in part.split()})
    vocabulary = [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY] if n > 1]
    net = Network(vocabulary, float(np.log(share / (1 - share))))
    if len(set(labels)) < 2:
        net.p["out"][:] = 0
        return net
    rng = np.random.default_rng(SEED)
    adam = Adam(net.p)
    def train(chosen: np.ndarray, rate: float) -> None:
        rng.shuffle(chosen)
        for lo in range(0, len(chosen), BATCH):
            rows = chosen[lo : lo + BATCH]
            words = sorted({w for r in rows for w in parts[r]} | {"a"})
            at = {w: i for i, w in enumerate(words)}
            index = np.zeros((len(rows), WINDOW), np.int64)
            mask = np.zeros((len(rows), WINDOW), bool)
            for i, r in enumerate(rows):
                index[i, : len(parts[r])] = [at[w] for w in parts[r]]
                mask[i, : len(parts[r])] = True
            adam.step(net.gradients(words, index, mask, y[of[rows]], rng.random(len(words)) < WORD_DROPOUT), rate)
            net.p["gram"] *= 1 - rate * GRAM_DECAY

    first = rng.random(len(parts)) * np.bincount(of)[of] < FIRST_WINDOWS
    for _ in range(EPOCHS_ALL):
        train(np.flatnonzero(first), RATE)

    def window_logits() -> np.ndarray:
        scorer = Scorer(net)
        return np.concatenate([scorer.logits(*scorer.windows(parts[lo : lo + 4000])[:2]) for lo in range(0, len(parts), 4000)])

    for epoch in range(EPOCHS_WORST):
        order = np.lexsort((-window_logits(), of))
        worst = order[np.concatenate([[True], of[order][1:] != of[order][:-1]])]
        clean = np.flatnonzero(y[of] == 0)
        others = rng.choice(clean, min(len(windows) // 2, len(clean)), replace=False)
        train(np.unique(np.concatenate([worst, others])), RATE * 0.5 ** (epoch // 3))
    return net


def train(docs: DataFrame, labels: DataFrame, trainable: F.Column, label: str = "toxic", rows: dict[int, int] | None = None) -> Network:
    ids = sample.labelled(labels, label, trainable, rows or SAMPLE_ROWS)
    if not ids:
        return fit([], [])
    own = materialize(sample.with_text(docs, ids), "toxicity-sample")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc, text, y = (c.to_pylist() for c in batch.columns)
            got = [drawn_windows(t, int(v > 0), zlib.crc32(str(d).encode())) for d, t, v in zip(doc, text, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.list_(pa.string()))], ["doc_id", "y", "windows"])

    got = own.select("doc_id", "text", "y").mapInArrow(windows, "doc_id long, y int, windows array<string>").collect()
    got = sorted((r.doc_id, int(r.y > 0), r.windows) for r in got)
    net = fit([w for _, _, w in got], [y for _, y, _ in got])
    if len({y for _, y, _ in got}) > 1:
        worst = sorted(logits(own, net, "y").collect())
        net.slope, net.offset = calibrate(np.array([r.logit for r in worst], np.float64), np.array([r.y > 0 for r in worst], np.float32))
    return net


def logits(docs: DataFrame, net: Network, keep: str) -> DataFrame:
    """keep (an int) and the logit of the worst window of each row's text."""
    shipped = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.worst(batch.column(1).to_pylist()).astype(np.float64))], [keep, "logit"])

    return docs.select(F.col(keep).cast("int").alias(keep), "text").mapInArrow(run, f"{keep} int, logit double")


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of each row's text: one map over the scan, no shuffle."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in chunks(batches):
            s = scorer(batch.column(1).to_pylist()).round(6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, learned from labelled rows that are not held out."""
    out = score(docs, train(docs, labels, ~crc_split(F.col("doc_id"), modulus, held)))
    return out.select("doc_id", crc_split(F.col("doc_id"), modulus, held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
