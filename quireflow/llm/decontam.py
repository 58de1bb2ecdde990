"""Benchmark decontamination by pigeonhole edit matching (operator 10).

An item of L characters may be matched with k = floor(L / CHARS_PER_ERROR)
edits.  It is cut into k + 1 pieces; a passage within k edits contains at least
one piece unchanged, so every piece hit (one pass of an automaton over the
text) names a window, and Myers' bit-parallel distance decides there.  Texts
and items are compared in lower case with white space collapsed.

Defined results: null or blank items match nothing; items with equal text all
match; null or empty texts contain nothing; an item shorter than
CHARS_PER_ERROR is matched exactly; repeated rows are judged alike.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import chunks, materialize, small_batches, work_path

CHARS_PER_ERROR = 14
#: Bytes of item texts sent to the executors at once; more items go in more blocks.
BLOCK_BYTES = 16 << 20


def normalize(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces_of(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 consecutive pieces (offset, text) of near equal length."""
    n = errors + 1
    cuts = [i * len(item) // n for i in range(n + 1)]
    return [(lo, item[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' bit-parallel search for one item."""

    def __init__(self, item: str):
        self.m = len(item)
        self.at: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.at[c] |= 1 << i
        self.at = dict(self.at)

    def best(self, text: str) -> int:
        """Least edit distance between the item and any part of the text."""
        full, high = (1 << self.m) - 1, 1 << (self.m - 1)
        pv, mv, score, least = full, 0, self.m, self.m
        at = self.at.get
        for c in text:
            eq = at(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
                least = min(least, score)
            ph <<= 1
            pv = (mh << 1) | (full & ~(xv | ph))
            pv &= full
            mv = ph & xv & full
        return least


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        by_text: dict[str, list[int]] = defaultdict(list)
        for item_id, text in items:
            if text:
                by_text[text].append(item_id)
        self.texts = sorted(by_text)
        self.ids = [sorted(set(by_text[t])) for t in self.texts]
        self.errors = [len(t) // CHARS_PER_ERROR for t in self.texts]
        self.patterns = [Pattern(t) for t in self.texts]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, text in enumerate(self.texts):
            for offset, piece in pieces_of(text, self.errors[k]):
                places[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), tuple(found)))
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str | None) -> list[tuple[int, int]]:
        """(item_id, least distance) of the items found in a text."""
        text = normalize(text)
        if not self.texts or not text:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (length, found) in self.automaton.iter(text):
            for k, offset in found:
                starts[k].add(end + 1 - length - offset)
        out = []
        for k, at in starts.items():
            e, size, best = self.errors[k], len(self.texts[k]), len(self.texts[k])
            for lo, hi in _merged(sorted(at), 2 * e + size):
                best = min(best, self.patterns[k].best(text[max(0, lo - e) : hi + size + e]))
                if not best:
                    break
            if best <= e:
                out += [(i, best) for i in self.ids[k]]
        return sorted(out)


def _merged(at: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of runs of starts whose windows overlap."""
    lo = hi = at[0]
    for x in at[1:]:
        if x - hi > gap:
            yield lo, hi
            lo = x
        hi = x
    yield lo, hi


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, normalised, one block of bounded size after another: a stated query set against all rows."""
    own = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    part = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for b in range(blocks):
        yield [(i, normalize(t)) for i, t in own.filter(part == b).collect()]


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, distance for every item found in a text.

    Each block of items is broadcast (its size is bounded) and met by one pass
    over the documents; nothing is shuffled.  Where there are several, the finds
    of each are written before the next block is read, so the driver and the
    executors hold one block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    src = docs.selectExpr("cast(doc_id as long) doc_id", "text")

    def finds(block: list[tuple[int, str]]) -> tuple[DataFrame, Broadcast]:
        shipped = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shipped.value)
            for batch in chunks(batches):
                found = [(d, i, e) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, e in matcher(t)]
                if found:
                    d, i, e = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(e, pa.int32())], ["doc_id", "item_id", "distance"])

        return src.mapInArrow(run, "doc_id long, item_id long, distance int"), shipped

    blocks = item_blocks(items)
    out, shipped = finds(next(blocks))
    path = None
    for block in blocks:
        path = path or work_path(spark, "leaks")
        out.write.mode("append").parquet(path)  # each block's finds are written once
        shipped.unpersist()
        out, shipped = finds(block)
    return out if path is None else spark.read.schema(out.schema).parquet(path).unionByName(out)


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of documents, all columns, whose text contains no item; written after each block but the last."""
    spark = docs.sparkSession
    small_batches(spark)
    at = docs.columns.index("text")
    shipped = None
    for block in item_blocks(items):
        if shipped is not None:
            docs = materialize(docs, "clean")
            shipped.unpersist()
        shipped = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shipped.value)
            for batch in chunks(batches):
                yield batch.filter(pa.array([not matcher(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
