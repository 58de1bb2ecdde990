"""Phrase collocations by relational mining: occurrence relations joined by piece and adjacent position.

The relation of all word occurrences is written once, sorted by piece and
position, in chunks of whole texts; a word stands in it as its place in the
chunk's vocabulary, and a gap ends each piece.  Words are counted by the rows of
the vocabularies, and the frequent ones, numbered, are semi-joined back to the
chunks.  An occurrence of k words is the merge of one of k - 1 words with the
word that follows it; the relation being sorted, the merge runs along a chunk.
Chunks count what they extend and deal the counts, packed, to buckets by a hash
of the phrase; a bucket sums them by one sort, and only the frequent phrases
return to their chunks, packed again, before the next length.  No set of phrases
is broadcast or gathered: a chunk gets back what it asked for.

A phrase is known by the numbers of its words, so counts are exact.  Scores are
floored in decimals of 38 digits, which hold counts up to 10^15.

Null texts count as empty; a null lang is ``und``.  Repeated rows count again.
Texts of any length are cut in no place but between pieces.  An empty table
gives no row.  Columns other than text and lang are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import materialize, mix, small_batches

#: Text bytes of a chunk, and places of one of its rows.
CHUNK_TEXT, ROW_PLACES = 20_000_000, 500_000
#: Marks between pieces and between words; A to Z become small, tabs blanks.
_ENDS, _GAP, _NONE = b".,;:!?\x0a\x0b\x0c\x0d", -1, -2
_TABLE = bytes.maketrans(_ENDS + b"\t" + bytes(range(65, 91)), b"\n" * len(_ENDS) + b" " + bytes(range(97, 123)))
#: Numbers of words fit half of a key.
HALF = 32
#: Words of all texts for one bucket of phrases; more texts make more buckets, not larger ones.
BUCKET_WORDS = 4_000_000
#: Parts of a lang's phrases that are ranked by themselves first.
RANK_PARTS = 64

_CHUNKS = "kind int, chunk long, seq int, code int, lang string, word string, n long, codes binary"


class Chunk:
    """Occurrences and vocabulary of some texts."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.texts: dict[str, list[bytes]] = {}
        self.held: dict[str, int] = {}
        self.words: dict[str, list[pa.Array]] = {}

    def add(self, lang: str, text: bytes) -> None:
        self.texts.setdefault(lang, []).append(text)
        self.held[lang] = self.held.get(lang, 0) + len(text)
        self.size += len(text)
        if self.held[lang] >= CHUNK_TEXT // 8:
            self._split(lang)

    def _split(self, lang: str) -> None:
        """The held texts of a lang as an array of words, with a mark between pieces; blanks side by side make empty words."""
        texts = b"\n".join([*self.texts.pop(lang), b""]).translate(_TABLE).replace(b"\n", b" \n ")
        self.held[lang] = 0
        self.words.setdefault(lang, []).append(pc.split_pattern(pa.array([texts], pa.large_binary()), pattern=" ").values)

    def batches(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.texts):
            self._split(lang)
        places, first = [], 0
        for lang in list(self.words):
            coded = pa.concat_arrays(self.words.pop(lang)).dictionary_encode()
            marks = pc.is_in(coded.dictionary, value_set=pa.array([b"", b"\n"], coded.dictionary.type))
            words = coded.dictionary.filter(pc.invert(marks))
            mark = marks.to_numpy(zero_copy_only=False)
            codes = np.full(len(mark), _NONE, np.int32)
            codes[~mark] = np.arange(first, first + len(words))
            gap = pc.index(coded.dictionary, pa.scalar(b"\n", coded.dictionary.type)).as_py()
            if gap >= 0:
                codes[gap] = _GAP
            own = codes[coded.indices.to_numpy()]
            places.append(own[own != _NONE])
            del coded, own
            counts = np.bincount(places[-1][places[-1] >= 0] - first, minlength=len(words))
            for at in range(0, len(words), 50_000):
                part = words.slice(at, 50_000)
                n = len(part)
                yield self._batch(n, kind=pa.array([0] * n, pa.int32()), code=pa.array(np.arange(first + at, first + at + n), pa.int32()), lang=pa.array([lang] * n), word=part.cast(pa.binary()).cast(pa.string()), n=pa.array(counts[at : at + n].astype(np.int64)))
            first += len(words)
        places = np.concatenate(places)
        for seq, at in enumerate(range(0, len(places), ROW_PLACES)):
            row = places[at : at + ROW_PLACES].astype("<i4").tobytes()
            yield self._batch(1, kind=pa.array([1], pa.int32()), seq=pa.array([seq], pa.int32()), codes=pa.array([row], pa.binary()))

    def _batch(self, rows: int, **columns: pa.Array) -> pa.RecordBatch:
        kinds = {"kind": pa.int32(), "chunk": pa.int64(), "seq": pa.int32(), "code": pa.int32(), "lang": pa.string(), "word": pa.string(), "n": pa.int64(), "codes": pa.binary()}
        columns["chunk"] = pa.array([self.number] * rows, pa.int64())
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, kind)) for c, kind in kinds.items()], list(kinds))


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (lang, text) as rows of chunks: vocabulary with counts (kind 0), and occurrences in order (kind 1)."""
    numbers = itertools.count(TaskContext.get().partitionId() << HALF)
    chunk = Chunk(next(numbers))
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            chunk.add(lang, text)
        if chunk.size >= CHUNK_TEXT:
            yield from chunk.batches()
            chunk = Chunk(next(numbers))
    if chunk.size or chunk.texts:
        yield from chunk.batches()


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table, with ``id``: numbers from 0 without gaps, given by partition and place in it."""
    own = materialize(df.withColumn("m", F.monotonically_increasing_id()), name)
    part = F.shiftright("m", 33)
    sizes = own.groupBy(part.alias("p")).count()  # one row a partition
    before = sizes.select("p", (F.sum("count").over(Window.orderBy("p")) - F.col("count")).alias("before"))
    at = F.col("before") + F.col("m").bitwiseAND((1 << 33) - 1)
    full = F.raise_error(F.lit("more than 2^31 frequent words"))
    return own.withColumn("p", part).join(before, "p").withColumn("id", F.when(at < 1 << 31, at).otherwise(full.cast("long"))).drop("p", "m", "before")


def _place(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where each key is in ``of``, which is sorted; -1 for one that isn't."""
    at = np.searchsorted(of, keys).astype(np.int32)
    at[at == len(of)] = 0
    return np.where(of[at] == keys, at, np.int32(-1)) if len(of) else np.full(len(keys), -1, np.int32)


def extended(table: pa.Table, length: int, buckets: int) -> pa.Table:
    """bucket, chunk, keys, words, counts: how often a chunk has each phrase of ``length`` words (2 or 3) whose shorter parts are frequent.

    A row has the phrases of a bucket, packed side by side.  The chunk's rows are
    its occurrences (level 0), the numbers of its frequent words by place (one row
    of level 1) and the keys of its frequent pairs (level 2, packed, a row a
    bucket).  A pair's key holds the numbers of both words; a phrase of three is
    its first pair's key and the third word.
    """
    chunk, level = table.column("chunk")[0].as_py(), table.column("level").to_numpy()
    rows = np.nonzero(level == 0)[0]
    rows = rows[np.argsort(table.column("seq").take(rows).to_numpy())]
    codes = np.concatenate([np.frombuffer(x.as_buffer(), "<i4") for x in table.column("codes").take(rows)])
    known = np.full(max(int(codes.max()), 0) + 2, -1, np.int32)  # the last place stands for the gap
    for row in np.nonzero(level == 1)[0]:
        known[table.column("keys")[row].values.to_numpy()] = table.column("ids")[row].values.to_numpy()
    pairs = np.sort(_unpacked(table.column("codes").take(np.nonzero(level == 2)[0]), "<i8"))
    word = known[codes]
    del codes, known, table  # a chunk is most of a task's memory
    starts = np.nonzero((word[:-1] >= 0) & (word[1:] >= 0))[0]
    joined = word[starts].astype(np.int64) << HALF | word[starts + 1]
    if length == 3:  # an occurrence goes on where the pair that begins at its second word is frequent, too
        own = np.full(len(word), -1, np.int32)
        own[starts] = _place(joined, pairs)
        starts = np.nonzero((own[:-1] >= 0) & (own[1:] >= 0))[0]
        joined = own[starts].astype(np.int64) << HALF | word[starts + 2]
    del word
    joined.sort()
    ends = np.nonzero(np.append(joined[1:] != joined[:-1], True))[0] if len(joined) else starts
    joined, counts = joined[ends], np.diff(ends, prepend=-1)
    if length == 3:
        joined, last = pairs[joined >> HALF] if len(joined) else joined, joined & ((1 << HALF) - 1)
    else:
        last = np.zeros(len(joined), np.int64)
    with np.errstate(over="ignore"):
        bucket = (mix(joined.view(np.uint64) + mix(last.view(np.uint64))) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    columns = [joined[order].astype("<i8"), last[order].astype("<i4") if length == 3 else None, counts[order].astype("<i4")]
    bucket = bucket[order]
    starts = np.nonzero(np.diff(bucket, prepend=-1))[0]
    ends = np.append(starts[1:], len(bucket))[: len(starts)]
    packed = [pa.nulls(len(starts), pa.binary()) if c is None else pa.array([c[x:y].tobytes() for x, y in zip(starts, ends, strict=True)], pa.binary()) for c in columns]
    return pa.table([pa.array(bucket[starts]), pa.array(np.full(len(starts), chunk), pa.int64()), *packed], ["bucket", "chunk", "keys", "words", "counts"])


def _unpacked(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The numbers of packed rows as one array."""
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in column)])


def summed(table: pa.Table, length: int, least: int) -> pa.Table:
    """chunk, key, word, f, keys: the phrases of a bucket that occur ``least`` times, and the packed keys of those of each chunk (f null)."""
    keys, counts = _unpacked(table.column("keys"), "<i8"), _unpacked(table.column("counts"), "<i4")
    words = _unpacked(table.column("words"), "<i4") if length == 3 else None
    order = np.argsort(keys, kind="stable") if words is None else np.lexsort((words, keys))
    sorted_keys, sorted_words = keys[order], None if words is None else words[order]
    new = np.diff(sorted_keys, prepend=sorted_keys[:1] - 1) != 0
    if words is not None:
        new |= np.diff(sorted_words, prepend=sorted_words[:1] - 1) != 0
    starts = np.nonzero(new)[0]
    sums = np.add.reduceat(counts[order].astype(np.int64), starts)
    often = sums >= least
    found = starts[often]
    out = [pa.table([pa.nulls(len(found), pa.int64()), pa.array(sorted_keys[found]), pa.array(np.zeros(len(found), np.int64) if words is None else sorted_words[found].astype(np.int64)), pa.array(sums[often]), pa.nulls(len(found), pa.binary())], _SUMMED)]
    if words is None:  # pairs return to their chunks
        keep = np.empty(len(keys), bool)
        keep[order] = np.repeat(often, np.diff(np.append(starts, len(keys))))
        chunks, ends = table.column("chunk").to_pylist(), np.cumsum([len(x.as_buffer()) // 8 for x in table.column("keys")])
        own = [(c, keys[x:y][keep[x:y]]) for c, x, y in zip(chunks, [0, *ends[:-1]], ends, strict=True)]
        own = [(c, k.tobytes()) for c, k in own if len(k)]
        n = len(own)
        out.append(pa.table([pa.array([c for c, _ in own], pa.int64()), *[pa.nulls(n, pa.int64())] * 3, pa.array([k for _, k in own], pa.binary())], _SUMMED))
    return pa.concat_tables(out)


_SUMMED = pa.schema([("chunk", pa.int64()), ("key", pa.int64()), ("word", pa.int64()), ("f", pa.int64()), ("keys", pa.binary())])


def _rows(df: DataFrame, level: int, **columns: Column) -> DataFrame:
    """Rows for ``extended``, of one level."""
    kinds = {"keys": "array<long>", "ids": "array<long>", "seq": "int", "codes": "binary"}
    return df.select("chunk", F.lit(level).alias("level"), *(columns.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()))


def extend(rows: DataFrame, length: int, least: int, buckets: int) -> DataFrame:
    """Frequent phrases of ``length`` words, and what returns to the chunks; see ``summed``."""
    dealt = rows.groupBy("chunk").applyInArrow(lambda t: extended(t, length, buckets), "bucket int, chunk long, keys binary, words binary, counts binary")
    return dealt.groupBy("bucket").applyInArrow(lambda t: summed(t, length, least), "chunk long, key long, word long, f long, keys binary")


def floored_score(a: str, first: str, rest: str) -> Column:
    """floor(1000000 * a * a / (first * rest)) in decimals."""
    d = lambda x: f"cast({x} as decimal(15, 0))"
    return F.expr(f"cast(1000000 as decimal(7, 0)) * {d(a)} * {d(a)} div ({d(first)} * {d(rest)})")


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of two and three words of each lang.

    a counts the phrase, l and r the parts of its lowest-scoring cut, n all
    words of the lang.  Phrases rarer than ``least`` are none, nor are pairs that
    stand in a longer phrase in at least ``inside`` per cent of their
    occurrences.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").filter("text is not null")
    store = materialize(texts.mapInArrow(chunks_of, _CHUNKS), "phrase-chunks")
    vocabulary, places = store.filter("kind = 0"), _rows(store.filter("kind = 1"), 0, seq=F.col("seq"), codes=F.col("codes"))
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    words = numbered(vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "phrase-words")
    words = materialize(words, "phrase-numbers")
    back = vocabulary.join(words.select("lang", "word", "id"), ["lang", "word"])
    back = back.groupBy("chunk").agg(F.collect_list(F.col("code").cast("long")).alias("keys"), F.collect_list("id").alias("ids"))
    known = materialize(_rows(back, 1, keys=F.col("keys"), ids=F.col("ids")), "phrase-known")

    every = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-every // BUCKET_WORDS))
    pairs = materialize(extend(places.unionByName(known), 2, least, buckets), "phrase-pairs")
    again = _rows(pairs.filter("f is null"), 2, codes=F.col("keys"))
    pairs = pairs.filter("f is not null")
    triples = extend(places.unionByName(known).unionByName(again), 3, least, buckets)
    second = F.shiftleft(F.col("key").bitwiseAND((1 << HALF) - 1), HALF).bitwiseOR(F.col("word")).alias("second")
    triples = materialize(triples.select("key", second, "f"), "phrase-triples")

    own = lambda at: words.select(F.col("id").alias(at), F.col("word").alias(f"w{at}"), F.col("f").alias(f"f{at}"), "lang")
    two = pairs.select("key", "f", F.shiftright("key", HALF).alias("1"), F.col("key").bitwiseAND((1 << HALF) - 1).alias("2"))
    two = materialize(two.join(own("1"), "1").join(own("2").drop("lang"), "2").select("key", "lang", "f", "w1", "w2", "f1", "f2"), "phrase-two")
    front = two.select("key", "lang", F.col("f").alias("ff"), F.concat_ws(" ", "w1", "w2").alias("w"), "f1")
    rear = two.select(F.col("key").alias("second"), F.col("f").alias("fr"), "w2", "f2")
    three = triples.join(front, "key").join(rear, "second")
    # the lower score counts, of equal ones the first cut
    three = three.withColumns({"s1": floored_score("f", "f1", "fr"), "s2": floored_score("f", "ff", "f2")}).withColumn("late", F.col("s2") < F.col("s1"))
    cut = lambda late, early: F.when(F.col("late"), F.col(late)).otherwise(F.col(early))
    three = three.select("lang", F.concat_ws(" ", "w", "w2").alias("phrase"), F.col("f").alias("a"), cut("ff", "f1").alias("l"), cut("f2", "fr").alias("r"), cut("s2", "s1").alias("score"))
    longer = triples.select("key", "f").unionByName(triples.select(F.col("second").alias("key"), "f")).groupBy("key").agg(F.max("f").alias("longer"))
    free = two.join(longer, "key", "left").filter(F.coalesce(100 * F.col("longer") < inside * F.col("f"), F.lit(True)))
    free = free.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), floored_score("f", "f1", "f2").alias("score"))
    return ranked(three.unionByName(free), top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The first of each lang.  Parts of a lang are cut to as many rows by themselves first, so no task ranks all."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    out = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).filter(F.col("rank") <= top)
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top).drop("part")
