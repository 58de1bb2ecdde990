"""Exact Jaccard join of documents' word shingles by partitioning the universe (operator 3).

Sizes fall into bands so wide that partners are in the same or the next band.
For a band with largest size L two partners differ in at most
``H = floor((1 - t) / (1 + t) * 2 L)`` shingles; the shingles are hashed into
``H + 1`` segments, and by the pigeonhole principle partners agree in one.

Allocation.  A segment is indexed whole at cost 1; an empty one would meet every
other empty one and gets 0.  If partners agree only in ``a`` segments that are
empty in both, the rest differ in at least one shingle each and at most
``a - 1`` of them in two or more.  So a document with ``e`` empty segments adds
the one-deletion neighbourhoods of the first segments until ``e`` of them hold
two shingles or more: among these one differs by exactly one shingle, and the
two documents share a set there.  A document too small for that also indexes
its empty segments.

A node is a distinct set, named by 64 bits of its hash, so equal texts are one
node wherever they are.  Candidates of a bucket are first tried against its
least node, so a group of near copies costs one pair a member.  After the
components of what links, only buckets that still hold several components are
open.  Their members outside the bucket's largest component meet the others in
blocks of bounded bytes, where a fingerprint of many small segments (two sets
differ at least in as many shingles as segments) leaves few pairs to compare;
no pair becomes a row unless it links.  Every link is verified on the whole
texts' shingle hashes.

Defined results: null and empty texts have no shingle and no link; a text with
fewer words than a shingle is one shingle; rows that share a doc_id are one
document, linked by the texts of all of them (a row without a shingle stays by
itself); rows with a null doc_id are documents of their own, and their
component_id is the least doc_id of the component, null if it has none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import NULL_ID, WordHashes, chunks, materialize, mix, ngram_hashes, ranges, small_batches
from quireflow.llm.components import settle_buckets

SHINGLE = 4
#: Similarity as a whole percentage: 100 * intersection >= PERCENT * union.
PERCENT = 85
GROUP = 1_500_000
#: Compressed bytes of one block of an open group.
BLOCK = 2_000_000
#: Kinds of rows: documents, sizes, pairs to try, members of shared buckets, delegates dealt by hash.
ROW, SIZE, PAIR, MEMBER, DELEGATE = range(5)
_NAMES = ["part", "kind", "payload"]
_SCHEMA = "part int, kind int, payload binary"


def shingle_set(text: str | None, hashes: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hashes(words)
    return np.unique(ngram_hashes(h, min(n, len(h))))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


@cache
def bands(percent: int, largest: int) -> tuple[int, ...]:
    """First sizes of the bands up to ``largest`` and beyond."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-100 * out[-1] // percent)))
    return (*out, max(out[-1] + 1, -(-100 * out[-1] // percent)))


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the index entries of one set: equal for two sets that share an entry."""
    n = len(s)
    starts = bands(percent, 1 << max(10, n.bit_length()))
    own = int(np.searchsorted(starts, n, side="right")) - 1
    out = []
    for band in (own, own + 1):
        if band > own and 100 * n < percent * starts[band]:
            continue
        h = (100 - percent) * 2 * (starts[band + 1] - 1) // (100 + percent)
        m = h + 1
        token = mix(s + np.uint64(band))
        seg = (token % np.uint64(m)).astype(np.int64)
        weight = mix(token ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        count = np.bincount(seg, minlength=m)
        total = np.zeros(m, np.uint64)
        np.add.at(total, seg, weight)
        place = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 40))
        full = count > 0
        out.append(mix(total[full] ^ place[full]))
        empty = m - int(full.sum())
        if empty:
            rich = np.cumsum(count >= 2)
            k = int(np.searchsorted(rich, empty)) + 1  # segments 0 to k - 1 hold enough that are not light
            if k > m:
                out.append(mix(place[~full] ^ np.uint64(0x5DEECE66D)))
            near = (seg < k) & (count[seg] >= 2)
            out.append(mix((total[seg[near]] - weight[near]) ^ place[seg[near]]))
    return np.unique(np.concatenate(out))


def _packed(part: int, kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    body = np.array([len(a)], np.int64).tobytes() + a.astype(np.int64, copy=False).tobytes() + b.tobytes()
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([kind], pa.int32()), pa.array([body], pa.binary())], _NAMES)


def _unpacked(body: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(body, np.int64, 1)[0])
    return np.frombuffer(body, np.int64, n, 8), np.frombuffer(body, kind, -1, 8 + 8 * n)


def node_of(s: np.ndarray) -> int:
    """The name of a set: 64 bits of its hash as a signed number; 0 for no shingle."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) if len(s) else 0


def index(docs: DataFrame, parts: int, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Packed rows of every kind from one pass over doc, same (a hash of the text), text.

    A task indexes each distinct set once; nodes of one bucket are tried against
    the first, which alone goes on as the bucket's delegate.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        seen: set[int] = set()
        keys, owners, rows, sizes, count = [], [], [], [], 0

        def settle() -> Iterator[pa.RecordBatch]:
            for kind, what in ((ROW, rows), (SIZE, sizes)):
                if what:
                    a = np.array(what, np.int64)
                    yield _packed(int(a[0, 1]) % parts, kind, a[:, 0], np.ascontiguousarray(a[:, 1:]))
            if not keys:
                return
            key, node = np.concatenate(keys), np.repeat(np.array(owners, np.int64), [len(k) for k in keys])
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            lead = np.concatenate([[True], key[1:] != key[:-1]])
            shared = ~lead | np.concatenate([~lead[1:], [False]])
            of = node[lead][np.cumsum(lead) - 1]
            more = ~lead & (node != of)
            if more.any():
                pairs = np.unique(np.stack([of[more], node[more]], 1), axis=0)
                yield _packed(int(pairs[0, 0]) % parts, PAIR, pairs[:, 0], pairs[:, 1])
            if shared.any():
                yield _packed(int(node[0]) % parts, MEMBER, key[shared].view(np.int64), node[shared])
            key, node = key[lead], node[lead]
            part = (key % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((node, part))
            key, node, part = key[order], node[order], part[order]
            cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                yield _packed(int(part[lo]), DELEGATE, node[lo:hi], key[lo:hi])

        for batch in chunks(batches):
            for doc, same, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingle_set(text, hashes, n)
                node = node_of(s)
                rows.append((doc, same, node))
                if node in seen:
                    continue
                seen.add(node)
                sizes.append((node, len(s)))
                if len(s):
                    keys.append(signatures(s, percent))
                    owners.append(node)
                    count += len(keys[-1])
            if count >= GROUP or len(rows) >= GROUP:
                yield from settle()
                seen.clear()
                keys, owners, rows, sizes, count = [], [], [], [], 0
        yield from settle()

    return docs.mapInArrow(run, _SCHEMA)


def buckets(packed: DataFrame, parts: int) -> DataFrame:
    """kind, a, b, c of all kinds but delegates; these become pairs and members where another task met their key."""
    names = ["kind", "a", "b", "c"]

    def flat(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        b = b.reshape(len(a), -1) if len(a) else b.reshape(0, 1)
        more = b[:, 1] if b.shape[1] > 1 else np.zeros(len(a), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), *(pa.array(np.ascontiguousarray(x)) for x in (a, b[:, 0], more))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for kind, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if kind == DELEGATE:
                    held.append(_unpacked(body, np.uint64))
                else:
                    yield flat(kind, *_unpacked(body, np.int64))
        if not held:
            return
        node, key = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((node, key))
        node, key = node[order], key[order]
        again = np.concatenate([[False], (key[1:] == key[:-1]) & (node[1:] == node[:-1])])  # a node that several tasks met
        node, key = node[~again], key[~again]
        lead = np.concatenate([[True], key[1:] != key[:-1]])
        shared = ~lead | np.concatenate([~lead[1:], [False]])
        of = node[lead][np.cumsum(lead) - 1]
        pairs = np.unique(np.stack([of[~lead], node[~lead]], 1), axis=0)
        yield flat(PAIR, pairs[:, 0], pairs[:, 1])
        yield flat(MEMBER, key[shared].view(np.int64), node[shared])

    return packed.repartitionById(parts, "part").mapInArrow(run, "kind int, a long, b long, c long")


def compressed(docs: DataFrame) -> DataFrame:
    """doc, same, z (the text) of doc, same, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            z = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z, pa.binary())], ["doc", "same", "z"])

    return docs.mapInArrow(run, "doc long, same long, z binary")


def verify(pairs: DataFrame, texts: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs a, b whose texts' shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        known: dict[int, np.ndarray] = {}

        def of(doc: int, z: bytes) -> np.ndarray:
            if doc not in known:
                if len(known) >= 500:
                    known.clear()
                known[doc] = shingle_set(zlib.decompress(z).decode("utf-8", "surrogatepass"), hashes, n)
            return known[doc]

        for batch in batches:
            a, b, za, zb = (c.to_pylist() for c in batch.columns)
            ok = [similar(of(p, x), of(q, y), percent) for p, q, x, y in zip(a, b, za, zb, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("z").alias("za"))
    right = texts.select(F.col("node").alias("b"), F.col("z").alias("zb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "za", "zb")
    return both.mapInArrow(run, "a long, b long")


def fingerprints(sets: list[np.ndarray], segments: int) -> np.ndarray:
    """One byte per segment and set; the number of differing bytes never exceeds that of differing shingles."""
    out = np.zeros((len(sets), segments), np.uint8)
    for k, s in enumerate(sets):
        np.bitwise_xor.at(out[k], (s % np.uint64(segments)).astype(np.int64), (mix(s) >> np.uint64(56)).astype(np.uint8))
    return out


class Block:
    """Sets of one block, held against sets of other blocks one at a time."""

    def __init__(self, nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int = PERCENT):
        self.nodes, self.labels, self.sets, self.percent = np.array(nodes, np.int64), np.array(labels, np.int64), sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        most = int((100 - percent) * 2 * self.sizes.max(initial=1) // (100 + percent))
        self.segments = 1 << max(6, min(13, (4 * most).bit_length()))
        self.marks = fingerprints(sets, self.segments)

    def links(self, node: int, label: int, s: np.ndarray, lead: int) -> list[int]:
        """Nodes of other components that link to a set; of two outside the lead component only one is asked for the other."""
        n, p = len(s), self.percent
        able = (self.labels != label) & ((self.labels == lead) | (self.nodes > node))
        able &= 100 * np.minimum(n, self.sizes) >= p * np.maximum(n, self.sizes)
        rows = np.flatnonzero(able)
        if not len(rows):
            return []
        differ = (self.marks[rows] != fingerprints([s], self.segments)[0]).sum(1)
        rows = rows[differ <= (100 - p) * (n + self.sizes[rows]) // (100 + p)]
        return [int(self.nodes[v]) for v in rows if similar(s, self.sets[v], p)]


def across(left: DataFrame, texts: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links a, b between components in open buckets (key, node, c, lead).

    Buckets with one lead component form a group.  Its nodes fall into blocks of
    about BLOCK compressed bytes by hash, each in one; the nodes outside the
    lead component visit every block one after another, so a task holds one
    block and one set.  With k nodes, u of them outside, u sets are held
    against k, and only links become rows.
    """
    group = left.select(F.col("lead").alias("g"), "node", "c").distinct().join(texts, "node")
    size = group.groupBy("g").agg(F.ceil(F.sum(F.octet_length("z")) / BLOCK).cast("int").alias("nb"))
    placed = group.join(size, "g")
    own = placed.withColumn("j", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")).withColumn("visits", F.lit(0))
    visits = placed.filter("c != g").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).withColumn("visits", F.lit(1))
    rows = own.unionByName(visits).select("g", "j", "visits", "node", "c", "z").repartition("g", "j").sortWithinPartitions("g", "j", "visits", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        at, held, block = None, ([], [], []), None
        for batch in batches:
            found: list[tuple[int, int]] = []
            for g, j, visits, node, c, z in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (g, j) != at:
                    at, held, block = (g, j), ([], [], []), None
                s = shingle_set(zlib.decompress(z).decode("utf-8", "surrogatepass"), hashes, n)
                if not visits:
                    for x, v in zip(held, (node, c, s), strict=True):
                        x.append(v)
                elif held[0]:
                    block = block or Block(*held, percent)
                    found += [(min(node, v), max(node, v)) for v in block.links(node, c, s, g)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, parts: int | None, n: int, percent: int, by_id: bool) -> DataFrame:
    """doc (NULL_ID for null), same, node, n_shingles, component (a node) of every row; by_id: rows of one doc_id are one document."""
    small_batches(docs.sparkSession)
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64("text").alias("same"), "text")
    parts = parts or ranges(own)
    entries = materialize(buckets(index(own, parts, n, percent), parts), "jaccard-index")
    of = lambda kind, *names: entries.filter(F.col("kind") == kind).select(*(F.col(x).alias(y) for x, y in zip("abc", names, strict=False)))
    members = of(MEMBER, "key", "node").distinct()
    rows = of(ROW, "doc", "same", "node")
    wanted = rows.join(members.select("node").distinct(), "node").groupBy("node").agg(F.min(F.struct("doc", "same")).alias("at")).select("node", "at.*")
    texts = compressed(own).join(wanted, ["doc", "same"]).groupBy("node").agg(F.min("z").alias("z"))
    texts = materialize(texts, "jaccard-texts")
    several = rows.filter((F.col("doc") != NULL_ID) & (F.col("node") != 0)).groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a != b")
    links = rows.filter("node != 0").join(several, "doc").select("a", F.col("node").alias("b")).filter("a != b").distinct()
    if not by_id:
        links = links.limit(0)
    tried = of(PAIR, "a", "b").distinct()
    label = settle_buckets(members, tried, links, lambda pairs: verify(pairs, texts, n, percent), lambda left: across(left, texts, n, percent), "jaccard")
    sizes = of(SIZE, "node", "n_shingles").distinct()
    return rows.join(sizes, "node").join(label, "node", "left").select("doc", "same", "node", "n_shingles", F.coalesce("component", "node").alias("component"))


def link(docs: DataFrame, parts: int | None = None, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    One pass indexes; the pairs that buckets propose are verified on compressed
    texts of candidate documents only.
    """
    rows = materialize(_grouped(docs, parts, n, percent, True), "jaccard-rows")
    doc = F.when(F.col("doc") != NULL_ID, F.col("doc"))
    alone = F.col("n_shingles") == 0
    first = rows.filter(~alone).groupBy("component").agg(F.min(doc).alias("least"))
    out = rows.join(first, "component", "left")
    return out.select(doc.alias("doc_id"), "n_shingles", F.when(alone, doc).otherwise(F.col("least")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of documents, all columns, that are the first of their group (or alone).

    Null doc_ids come first; rows with one doc_id and one text stay or go
    together, rows with one doc_id and unlike texts are judged apart.
    """
    rows = materialize(_grouped(docs, None, SHINGLE, PERCENT, False).filter("n_shingles > 0").select("doc", "same", "component").distinct(), "jaccard-rows")
    first = rows.groupBy("component").agg(F.min(F.struct("doc", "same")).alias("first"))
    later = rows.join(first, "component").filter("first.doc != doc or first.same != same").select(F.struct("doc", "same").alias("later"))
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    doc = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NULL_ID))
    kept = row.join(later, (doc == F.col("later.doc")) & (F.xxhash64("row.text") == F.col("later.same")), "left_anti")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
