"""Exact substring dedup by difference-cover anchors (operator 5).

Windows of WINDOW words that also start earlier are removed.  Hashing every
window of a corpus would shuffle one row per word; instead the words at
positions whose remainder modulo PERIOD lies in a difference cover start
anchors of ANCHOR words.  Any two positions have a common shift below PERIOD
that brings both into the cover, so two equal windows always share an aligned
anchor.  Only windows around anchors that occur twice are hashed whole
(96 bits), and the earliest occurrence of each keeps its words.

Work goes by packed blocks: a task keeps one delegate of each hash it meets and
settles the other occurrences itself, so no hash reaches a later task more
often than there were tasks; blocks are dealt by hash range and then back to
the documents' buckets.  Nothing is broadcast or collected.

Defined results: null or empty texts have no words; texts shorter than WINDOW
words keep all; rows with a null doc_id come before all others, in the order of
a hash of their text (with equal texts they count as one); rows that share a doc_id are versions of one document, and a start that
is removed in one version is removed in each that is long enough.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import NULL_ID, NULL_SPAN, WordHashes, chunks, known_id, mix, ranges, small_batches

WINDOW = 20
PERIOD = 13
#: A perfect difference cover modulo 13 (fixed values): every remainder is a difference of two of these.
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Delegates gathered by a task before it settles them; bounds memory only.
GROUP = 1_500_000
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_SCHEMA = "part int, kind int, doc_id long, payload binary"
_NAMES = ["part", "kind", "doc_id", "payload"]
#: Kinds of rows: marks of documents come before their texts; delegates are dealt by hash.
MARKS, TEXT, DELEGATES = 0, 1, 2


def words_of(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and \\t to \\r."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def bucket_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix(doc.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def pack(doc: np.ndarray, pos: np.ndarray, *more: np.ndarray) -> bytes:
    """Rows in order of documents as planes: ids once per run, positions in two halves, further columns raw."""
    new = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
    counts = np.diff(np.append(new, len(doc))).astype(np.uint32)
    p = pos.astype(np.uint32)
    head = np.array([len(doc), len(new)], np.int64).tobytes()
    return b"".join([head, doc[new].astype(np.int64).tobytes(), counts.tobytes(), (p & 0xFFFF).astype(np.uint16).tobytes(), (p >> 16).astype(np.uint16).tobytes(), *(m.tobytes() for m in more)])


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    n, docs = np.frombuffer(data, np.int64, 2)
    at = 16
    out = []
    for kind, size in ((np.int64, docs), (np.uint32, docs), (np.uint16, n), (np.uint16, n), *((k, n) for k in kinds)):
        out.append(np.frombuffer(data, kind, size, at))
        at += out[-1].nbytes
    ids, counts, low, high = out[:4]
    return [np.repeat(ids, counts), low.astype(np.int64) | high.astype(np.int64) << 16, *out[4:]]


def _rows(part, kind, doc, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(doc, pa.int64()), pa.array(payload, pa.binary())], _NAMES)


def deal(part: np.ndarray, kind: int, doc: np.ndarray, pos: np.ndarray, *more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed row per part."""
    if not len(part):
        return
    order = np.lexsort((pos, doc, part))
    part, doc, pos, more = part[order], doc[order], pos[order], [m[order] for m in more]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        yield _rows([int(part[lo])], [kind], [0], [pack(doc[lo:hi], pos[lo:hi], *(m[lo:hi] for m in more))])


class Layout:
    """Word hashes of many texts end to end, with each word's place."""

    def __init__(self, words: list[list[bytes]], hashes: WordHashes):
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.h = hashes([x for w in words for x in w])
        self.pos = np.arange(len(self.h)) - np.repeat(self.starts, self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.pos  # words from here to the end of the text

    def runs(self, at: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
        """Hashes of the n words from each place."""
        with np.errstate(over="ignore"):
            acc = np.full(len(at), salt * 0x9E3779B97F4A7C15 + n & (2**64 - 1), np.uint64)
            for j in range(n):
                acc = mix(acc * np.uint64(0xD1342543DE82EF95) + self.h[at + j])
        return acc


def anchors(docs: DataFrame, parts: int) -> DataFrame:
    """Packed anchors: delegates by hash range, and marks of the anchors that a task itself saw twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, count = WordHashes(), [], 0

        def settle() -> Iterator[pa.RecordBatch]:
            key, doc, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(key, kind="stable")
            key, doc, pos = key[order], doc[order], pos[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            twice = ~first | np.concatenate([~first[1:], [False]])
            yield from deal(bucket_of(doc[twice], parts), MARKS, doc[twice], pos[twice])
            k = key[first]
            yield from deal((k % np.uint64(parts)).astype(np.int64), DELEGATES, doc[first], pos[first], (k >> np.uint64(16)).astype(np.uint32), (k >> np.uint64(48)).astype(np.uint16))

        for batch in chunks(batches):
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            lay = Layout(words, hashes)
            at = np.flatnonzero(_IN_COVER[lay.pos % PERIOD] & (lay.left >= ANCHOR) & (lay.pos + lay.left >= WINDOW))
            if len(at):
                doc = np.repeat(np.array(batch.column(0).to_pylist(), np.int64), lay.sizes)[at]
                held.append((lay.runs(at, ANCHOR), doc, lay.pos[at]))
                count += len(at)
                if count >= GROUP:
                    yield from settle()
                    held, count = [], 0
        if held:
            yield from settle()

    return docs.mapInArrow(run, _SCHEMA)


def shared_anchors(packed: DataFrame, parts: int) -> DataFrame:
    """Marks, by documents' buckets, of delegates whose hash another task met too; other marks pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            marks = pc.equal(batch.column(1), MARKS)
            if pc.any(marks).as_py():
                yield batch.filter(marks)
            held += [(p, *unpack(x, np.uint32, np.uint16)) for p, k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True) if k == DELEGATES]
        if not held:
            return
        key = np.concatenate([a.astype(np.uint64) | b.astype(np.uint64) << np.uint64(32) for _, _, _, a, b in held])
        part = np.concatenate([np.full(len(a), p) for p, _, _, a, _ in held])
        doc, pos = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
        order = np.lexsort((part, key))
        same = (key[order][1:] == key[order][:-1]) & (part[order][1:] == part[order][:-1])
        twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        yield from deal(bucket_of(doc[twice], parts), MARKS, doc[twice], pos[twice])

    return packed.repartitionById(parts, "part").mapInArrow(run, _SCHEMA)


def packed_texts(docs: DataFrame, parts: int) -> DataFrame:
    """Every text, compressed, by its document's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            doc = np.array(batch.column(0).to_pylist(), np.int64)
            texts = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in batch.column(1).to_pylist()]
            yield _rows(bucket_of(doc, parts), np.full(len(doc), TEXT), doc, texts)

    return docs.mapInArrow(run, _SCHEMA)


class Marks:
    """Positions by document, gathered from packed rows."""

    def __init__(self, payloads: list[bytes]):
        got = [unpack(x) for x in payloads]
        doc = np.concatenate([g[0] for g in got]) if got else np.empty(0, np.int64)
        pos = np.concatenate([g[1] for g in got]) if got else np.empty(0, np.int64)
        order = np.lexsort((pos, doc))
        self.doc, self.pos = doc[order], pos[order]

    def of(self, doc: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.doc, [doc, doc], "left")[0], np.searchsorted(self.doc, doc, "right")
        return self.pos[lo:hi]


def _with_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Marks, list[tuple[int, bytes]]]]:
    """Texts in groups of some size, after all marks of the partition (rows come in order of kind)."""
    payloads, marks, texts, size = [], None, [], 0
    for batch in batches:
        for kind, doc, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if kind == MARKS:
                payloads.append(payload)
                continue
            marks = marks or Marks(payloads)
            texts.append((doc, payload))
            size += len(payload)
            if size > 2_000_000:
                yield marks, texts
                texts, size = [], 0
    if texts:
        yield marks, texts


def repeated_windows(rows: DataFrame, parts: int) -> DataFrame:
    """From marks and texts: delegates of all windows around marked anchors, and marks of starts settled here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, count = WordHashes(), [], 0

        def settle() -> Iterator[pa.RecordBatch]:
            a, b, doc, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((pos, doc, b, a))
            a, b, doc, pos = a[order], b[order], doc[order], pos[order]
            first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            later = (doc != doc[lead]) | (pos != pos[lead])
            yield from deal(bucket_of(doc[later], parts), MARKS, doc[later], pos[later])
            yield from deal((a[first] % np.uint64(parts)).astype(np.int64), DELEGATES, doc[first], pos[first], a[first], b[first])

        for marks, texts in _with_marks(batches):
            with_marks = [(d, at, x) for d, x in texts if len(at := marks.of(d))]
            if not with_marks:
                continue
            words = [zlib.decompress(x).split() for _, _, x in with_marks]
            lay = Layout(words, hashes)
            step = np.zeros(len(lay.h) + 1, np.int32)
            for (_, at, _), start, n in zip(with_marks, lay.starts, lay.sizes, strict=True):
                lo, hi = np.maximum(at - (WINDOW - ANCHOR), 0), np.minimum(at, n - WINDOW)
                ok = lo <= hi
                np.add.at(step, start + lo[ok], 1)
                np.add.at(step, start + hi[ok] + 1, -1)
            at = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            if len(at):
                doc = np.repeat(np.array([d for d, _, _ in with_marks], np.int64), lay.sizes)[at]
                held.append((lay.runs(at, WINDOW, 1), (lay.runs(at, WINDOW, 2) >> np.uint64(32)).astype(np.uint32), doc, lay.pos[at]))
                count += len(at)
                if count >= GROUP:
                    yield from settle()
                    held, count = [], 0
        if held:
            yield from settle()

    return rows.repartitionById(parts, "part").sortWithinPartitions("kind").mapInArrow(run, _SCHEMA)


def later_windows(packed: DataFrame, parts: int) -> DataFrame:
    """Marks, by documents' buckets, of starts of windows that start earlier elsewhere; other marks pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            marks = pc.equal(batch.column(1), MARKS)
            if pc.any(marks).as_py():
                yield batch.filter(marks)
            held += [unpack(x, np.uint64, np.uint32) for k, x in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True) if k == DELEGATES]
        if not held:
            return
        doc, pos, a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((pos, doc, b, a))
        a, b, doc, pos = a[order], b[order], doc[order], pos[order]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        lead = np.flatnonzero(first)[np.cumsum(first) - 1]
        later = (doc != doc[lead]) | (pos != pos[lead])
        yield from deal(bucket_of(doc[later], parts), MARKS, doc[later], pos[later])

    return packed.repartitionById(parts, "part").mapInArrow(run, _SCHEMA)


def kept_texts(rows: DataFrame, parts: int, keep_text: bool = False) -> DataFrame:
    """Per document: words, removed words and the digest of what is kept; ``keep_text`` adds the kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks, texts in _with_marks(batches):
            out = []
            for doc, x in texts:
                words = zlib.decompress(x).split()
                at = marks.of(doc)
                at = at[at <= len(words) - WINDOW]
                kept = words
                if len(at):
                    step = np.zeros(len(words) + 1, np.int32)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + WINDOW, -1)
                    kept = [w for w, gone in zip(words, (np.cumsum(step[:-1]) > 0).tolist(), strict=True) if not gone]
                text = b" ".join(kept)
                out.append((None if doc < NULL_ID + NULL_SPAN else doc, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace")))
            cols = list(zip(*out, strict=True))[: 5 if keep_text else 4]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=False)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: len(cols)])

    return rows.repartitionById(parts, "part").sortWithinPartitions("kind").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text)


def remove_repeats(docs: DataFrame, parts: int | None = None, keep_text: bool = False) -> DataFrame:
    """One row per document with what is left after removing every word of a window that starts earlier.

    ``parts`` (by default one for RANGE_BYTES of text, the session's shuffle partitions at least) sets the
    ranges of hashes and the buckets of documents; a part is held in memory in
    packed form, so it should grow with the corpus.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts or ranges(docs)
    own = docs.select(known_id(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    texts = packed_texts(own, parts)
    marks = shared_anchors(anchors(own, parts), parts)
    starts = later_windows(repeated_windows(marks.unionByName(texts), parts), parts)
    return kept_texts(starts.unionByName(texts), parts, keep_text)
