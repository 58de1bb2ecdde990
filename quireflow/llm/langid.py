"""Language identification by hyperdimensional profiles (operator 7).

Every letter has a random bipolar vector.  A letter n-gram is the elementwise
product of its letters' vectors, each permuted by its place; a text is the
bundle (sum) of its n-gram vectors; a language is the bundle of its training
texts, each scaled to unit length.  A text goes to the language of largest
cosine.

Defined results: a text that is null or has no letter gets ``und`` and score 0;
a negative cosine scores 0; ties go to the language that sorts first; texts of
the training set with null lang are not learned from.  With no training text at
all every text is ``und``; a filter by language then raises, since it would drop
every row.  Each letter has a vector of its own, upper and lower case the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import chunks, crc_split, mix, small_batches
from quireflow.llm.sample import drawn

DIMENSIONS = 512
NGRAM = 3
#: Symbols: 0 between words, else the code point of a letter in lower case; three of them fit a 64-bit code.
SYMBOLS = 1 << 21
#: A text of fewer n-grams has a low cosine with any language: the least score asked of it falls in proportion.
FULL_NGRAMS = 100
#: Training texts in expectation, drawn by a hash of doc_id over all training rows.
SAMPLE_ROWS = 6000
SEED = 20260101


@cache
def letter_classes() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter; upper and lower case share one."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            out[cp] = ord(c.lower()[0])
    return out


class Profiles:
    """Vectors of letters and n-grams."""

    def __init__(self, dimensions: int = DIMENSIONS, ngram: int = NGRAM):
        self.ngram, self.dimensions = ngram, dimensions
        self.classes = letter_classes()
        self.places = mix(np.arange(-(-dimensions // 64), dtype=np.uint64) + np.uint64(SEED))

    def letters(self, symbols: np.ndarray) -> np.ndarray:
        """One random bipolar row per symbol: the bits of hashes of symbol and place, the same in every process."""
        with np.errstate(over="ignore"):
            words = mix(mix(symbols.astype(np.uint64))[:, None] + self.places)
        bits = np.unpackbits(words.view(np.uint8).reshape(len(symbols), -1), axis=1)[:, : self.dimensions]
        return (2 * bits.astype(np.int8) - 1).astype(np.int8)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One bipolar row per n-gram code: letters' vectors, rotated by place, multiplied."""
        out = np.ones((len(codes), self.dimensions), np.int8)
        for place in range(self.ngram):
            symbols, which = np.unique(codes >> 21 * place & (SYMBOLS - 1), return_inverse=True)
            out *= np.roll(self.letters(symbols), place, axis=1)[which]
        return out.astype(np.float32)

    def codes(self, text: str) -> np.ndarray:
        """Codes of the n-grams of a text: runs of other characters become one separator, also at both ends."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        cls = self.classes[points]
        if not cls.any():
            return np.empty(0, np.int64)
        cls = np.concatenate([np.zeros(1, np.uint32), cls, np.zeros(1, np.uint32)])
        cls = cls[(cls != 0) | np.concatenate([np.ones(1, bool), cls[:-1] != 0])].astype(np.int64)
        k = len(cls) - self.ngram + 1
        return sum(cls[j : j + k] << 21 * j for j in range(self.ngram))

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """One row per text; zero for a text without letters."""
        return self.bundle_codes([self.codes(t or "") for t in texts])

    def bundle_codes(self, codes: list[np.ndarray]) -> np.ndarray:
        """One row per text, from the codes of its n-grams."""
        got = [np.unique(c, return_counts=True) for c in codes]
        out = np.zeros((len(codes), self.dimensions), np.float32)
        for at in range(0, len(got), 64):  # dense blocks: counts x vectors
            part = got[at : at + 64]
            every = np.unique(np.concatenate([c for c, _ in part]))
            if not len(every):
                continue
            counts = np.zeros((len(part), len(every)), np.float32)
            for row, (c, n) in enumerate(part):
                counts[row, np.searchsorted(every, c)] = n
            for lo in range(0, len(every), 8192):
                out[at : at + len(part)] += counts[:, lo : lo + 8192] @ self.vectors(every[lo : lo + 8192])
        return out


def learn(docs: DataFrame, trainable: F.Column, sample_rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Unit prototype of each language, from texts of rows where ``trainable`` holds and lang is not null.

    The sums are made on the executors; the driver gets languages x dimensions numbers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.filter(trainable & F.col("lang").isNotNull())
    total = rows.select("doc_id").count()  # reads two narrow columns
    rows = rows.filter(F.col("text").isNotNull() & drawn("doc_id", SEED, sample_rows, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, sums = Profiles(), {}
        for batch in chunks(batches):
            v = profiles.bundle(batch.column(1).to_pylist())
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            v = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + v[langs == lang].sum(0, dtype=np.float64)
        for lang, v in sums.items():
            # whole numbers, so that the sum does not depend on the order of the parts
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(v)), pa.array(range(len(v)), pa.int32()), pa.array(np.rint(v * 1e6).astype(np.int64))], ["lang", "dim", "v"])

    got = rows.select("lang", "text").mapInArrow(run, "lang string, dim int, v long").groupBy("lang", "dim").agg(F.sum("v").alias("v")).collect()
    out: dict[str, np.ndarray] = {}
    for lang, dim, v in got:
        out.setdefault(lang, np.zeros(DIMENSIONS))[dim] = v
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id alone by default) with lang_pred and score of each row's text."""
    small_batches(docs.sparkSession)
    keep = keep or ["doc_id"]
    names = list(prototypes)
    matrix = np.array([prototypes[k] for k in names], np.float32).reshape(len(names), DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles()
        for batch in chunks(batches, "__text"):
            v = profiles.bundle(batch.column(batch.num_columns - 1).to_pylist())
            norm = np.linalg.norm(v, axis=1)
            if names:
                cosine = (v @ matrix.T) / np.maximum(norm, 1e-9)[:, None]
                best = cosine.argmax(1)
                score = np.clip(cosine[np.arange(len(v)), best], 0, 1)
                pred = [names[b] if n > 0 else "und" for b, n in zip(best, norm, strict=True)]
            else:
                score, pred = np.zeros(len(v)), ["und"] * len(v)
            score = np.where(norm > 0, score, 0.0).round(6)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score.astype(np.float64))], [*keep, "lang_pred", "score"])

    src = docs.select(*keep, F.col("text").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows that are not held out."""
    prototypes = learn(docs, ~crc_split(F.col("doc_id"), modulus, held))
    out = predict(docs.withColumn("doc_id", F.col("doc_id").cast("long")), prototypes)
    return out.select("doc_id", crc_split(F.col("doc_id"), modulus, held).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float, modulus: int = 4, held: int = 2) -> DataFrame:
    """The rows of documents, all columns, whose text has a language with at least this score.

    Of a text of fewer than FULL_NGRAMS n-grams only that share of the score is asked.
    Raises where there are rows, but no language could be learned.
    """
    prototypes = learn(docs, ~crc_split(F.col("doc_id"), modulus, held))
    if not prototypes and not docs.isEmpty():
        raise ValueError("no text with a language to learn from: every document would go")
    matrix = np.array(list(prototypes.values()), np.float32).reshape(len(prototypes), DIMENSIONS)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles()
        for batch in chunks(batches):
            codes = [profiles.codes(t or "") for t in batch.column(at).to_pylist()]
            v = profiles.bundle_codes(codes)
            norm = np.linalg.norm(v, axis=1)
            best = (v @ matrix.T).max(1, initial=-1) / np.maximum(norm, 1e-9)
            asked = least * np.minimum(1, np.array([len(c) for c in codes]) / FULL_NGRAMS)
            yield batch.filter(pa.array((norm > 0) & (best >= asked), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
