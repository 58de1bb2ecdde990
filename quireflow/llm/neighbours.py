"""Approximate nearest neighbours by inner product: collision-counting hashing with query-centred windows.

Vectors are dealt to blocks of about BLOCK by a hash of their id.  A block's
index has, for each of LINES random lines, the sorted array of its vectors'
projections.  A query is projected to the same lines; its window on a line is
centred on its own projection and grows with the search radius (virtual
rehashing), so nothing is hashed anew.  A vector that lies in enough windows
collides, is verified by its exact inner product, and the radius stops growing
when as many verified vectors as wanted lie within it.  A block of vectors of
unequal length is lifted by one component, which makes the largest inner product
the least distance.  No block's candidates are capped: the windows grow until
they hold the block where that is needed.

The index is a table; queries, a stated set, meet every block of their length,
stream through it in batches and leave their best of the block, of which the
best of all blocks are ranked.

Rows without an id, and vectors that are null, empty, zero or hold a null or
non-finite component, take no part.  Rows that share an id are one: the least of
their vectors, component by component.  Vectors of different length don't meet.
Ties go to the smaller id.  An empty table gives no row; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.llm.common import materialize

#: Vectors of a block on average, and lines of its index.
BLOCK, LINES = 8192, 48
#: A window's half width at radius 1, and the share of windows that a vector must lie in to be verified.
HALF_WIDTH, SHARE = 0.75, 0.42
#: Factor from one radius to the next, and vectors of a block whose own searches tell the first.
GROWTH, SAMPLE = 1.06, 32
SEED = 20260311

_INDEX = "dim int, block int, kind int, seq long, ids binary, numbers binary"


def usable(vec_id: Column, vector: Column) -> Column:
    """True for a row that takes part."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec_id.isNotNull() & F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def lines_of(dim: int, lines: int = LINES) -> np.ndarray:
    """Random directions for vectors of ``dim`` components and the one they are lifted by."""
    return np.random.default_rng(SEED + dim).standard_normal((lines, dim + 1)).astype(np.float32)


def build_block(table: pa.Table, lines: int = LINES) -> pa.Table:
    """The rows of a block's index: its ids and vectors, then each line's order and sorted projections."""
    dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], flat.astype(np.float64).reshape(-1, dim)[by_id]
    even = vectors / np.abs(vectors).max()
    square = (even * even).sum(axis=1)
    lift = np.sqrt(np.maximum(square.max() - square, 0))
    placed = np.concatenate([even, lift[:, None]], axis=1).astype(np.float32) @ lines_of(dim, lines).T
    order = np.argsort(placed, axis=0, kind="stable").astype(np.int32)
    rows = [(0, -1, ids.astype("<i8").tobytes(), vectors.astype("<f8").tobytes())]
    for k in range(lines):
        rows.append((0, k, order[:, k].tobytes(), placed[order[:, k], k].tobytes()))
    kinds, seqs, own, numbers = zip(*rows, strict=True)
    n = len(rows)
    columns = [pa.array([dim] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(kinds, pa.int32()), pa.array(seqs, pa.int64()), pa.array(own, pa.binary()), pa.array(numbers, pa.binary())]
    return pa.table(columns, ["dim", "block", "kind", "seq", "ids", "numbers"])


class Block:
    """A block's index, searched by batches of queries."""

    def __init__(self, dim: int, k: int, lines: int, half_width: float, share: float):
        self.dim, self.k, self.half_width, self.enough = dim, k, half_width, max(1, math.ceil(share * lines))
        self.lines = lines_of(dim, lines)
        self.order: list[np.ndarray] = [np.empty(0, np.intp)] * lines
        self.placed: list[np.ndarray] = [np.empty(0, np.float32)] * lines

    def take(self, seq: int, ids: bytes, numbers: bytes) -> None:
        """One row of the index; the ids and vectors are the first."""
        if seq >= 0:
            self.order[seq] = np.frombuffer(ids, np.int32).astype(np.intp)
            self.placed[seq] = np.frombuffer(numbers, np.float32)
            return
        self.ids = np.frombuffer(ids, "<i8")
        self.vectors = np.frombuffer(numbers, "<f8").reshape(-1, self.dim)
        self.scale = float(np.abs(self.vectors).max())
        even = self.vectors / self.scale
        self.top = float((even * even).sum(axis=1).max())
        some = self.vectors[:: max(1, len(even) // SAMPLE)]  # any first radius is right, this one is near the last
        kth = -np.partition(-(even @ self._lengthened(some).T), min(self.k, len(even) - 1), axis=0)[min(self.k, len(even) - 1)]
        self.first = math.sqrt(max(2 * (self.top - float(np.median(kth))), 1e-6 * self.top))

    def _lengthened(self, queries: np.ndarray) -> np.ndarray:
        """Queries of the block's largest length: their own doesn't change which vectors are nearest."""
        even = queries / np.abs(queries).max(axis=1, keepdims=True)
        return even * (math.sqrt(self.top) / np.sqrt((even * even).sum(axis=1, keepdims=True)))

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and inner products of the k nearest found, its own row left out."""
        even = self._lengthened(queries)
        centres = even.astype(np.float32) @ self.lines[:, : self.dim].T
        half = np.float32(self.half_width * self.first)
        low = np.stack([p.searchsorted(c - half) for p, c in zip(self.placed, centres.T, strict=True)], axis=1).tolist()
        high = np.stack([p.searchsorted(c + half, side="right") for p, c in zip(self.placed, centres.T, strict=True)], axis=1).tolist()
        for at, query_id in enumerate(query_ids):
            yield self._search(query_id, queries[at], even[at], centres[at], low[at], high[at])

    def _search(self, query_id: int, query: np.ndarray, even: np.ndarray, centre: np.ndarray, low: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        fresh = np.ones(n, bool)
        own = np.searchsorted(self.ids, query_id)
        if own < n and self.ids[own] == query_id:
            fresh[own] = False
        wanted = min(self.k, int(np.count_nonzero(fresh)))
        radius, count = self.first, 0
        new = [order[a:b] for order, a, b in zip(self.order, low, high, strict=True)]
        found, near = [], []
        while True:
            count = count + np.bincount(np.concatenate(new), minlength=n)
            hit = np.nonzero((count >= self.enough) & fresh)[0]
            fresh[hit] = False
            found.append(hit)
            near.append(self.vectors[hit] @ (even / self.scale))
            here = np.concatenate(near)
            if len(here) >= wanted and (np.count_nonzero(here >= self.top - radius * radius / 2) >= wanted or min(high) == n and max(low) == 0):
                break
            radius *= GROWTH
            half, new = np.float32(self.half_width * radius), []
            for i, (placed, order, c) in enumerate(zip(self.placed, self.order, centre, strict=True)):
                a, b = min(low[i], int(placed.searchsorted(c - half))), max(high[i], int(placed.searchsorted(c + half, side="right")))
                new += [order[a : low[i]], order[high[i] : b]]
                low[i], high[i] = a, b
        at = np.concatenate(found)
        if len(at) > self.k:  # all that may be among the best, ties and rounding included
            at = at[here >= np.partition(here, -self.k)[-self.k] - 1e-9 * self.top]
        scores = (self.vectors[at] * query).sum(axis=1)
        best = np.lexsort((self.ids[at], -scores))[: self.k]
        return self.ids[at[best]], scores[best]


def searched(batches: Iterator[pa.RecordBatch], k: int, lines: int, half_width: float, share: float) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score of each block's best, from rows sorted so that a block's index comes before its queries."""
    block, at = None, None
    for batch in batches:
        dims, numbers, kinds = (batch.column(c).to_numpy() for c in ("dim", "block", "kind"))
        cuts = np.nonzero((np.diff(dims) != 0) | (np.diff(numbers) != 0) | (np.diff(kinds) != 0))[0] + 1
        for start, end in zip([0, *cuts], [*cuts, len(dims)], strict=True):
            if start == end:
                continue
            if at != (dims[start], numbers[start]):
                at = (dims[start], numbers[start])
                block = Block(int(dims[start]), k, lines, half_width, share)
            own = batch.slice(start, end - start)
            seq, data = own.column("seq").to_numpy(), own.column("numbers")
            if kinds[start] == 0:
                for row in range(own.num_rows):
                    block.take(int(seq[row]), own.column("ids")[row].as_py(), data[row].as_py())
                continue
            queries = np.stack([np.frombuffer(x.as_buffer(), "<f8") for x in data])
            found = list(block.search(seq, queries))
            counts = [len(ids) for ids, _ in found]
            ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(seq, counts)), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])


def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries as rows of the index's form."""
    for batch in batches:
        vectors = [np.array(v, "<f8").tobytes() for v in batch.column("vector").to_pylist()]
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("dim"), batch.column("block"), pa.array([1] * n, pa.int32()), batch.column("vec_id"), pa.nulls(n, pa.binary()), pa.array(vectors, pa.binary())], ["dim", "block", "kind", "seq", "ids", "numbers"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK, lines: int = LINES, half_width: float = HALF_WIDTH, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: of every query its k nearest found among all other rows (vec_id, embedding).

    ``is_query`` is a condition on vec_id.  The driver holds one count for each
    length of vectors.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    own = own.filter(usable(F.col("vec_id"), F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    own = materialize(own.withColumn("dim", F.size("vector")), "nearest-vectors")
    blocks = {r.dim: max(1, -(-r["count"] // block)) for r in own.groupBy("dim").count().collect()}
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of_dim = F.element_at(F.create_map(*(F.lit(x) for pair in blocks.items() for x in pair)), F.col("dim"))
    dealt = own.withColumn("block", F.pmod(F.xxhash64("vec_id"), of_dim).cast("int"))
    index = materialize(dealt.groupBy("dim", "block").applyInArrow(lambda t: build_block(t, lines), _INDEX), "nearest-index")
    asked = own.filter(is_query).withColumn("block", F.explode(F.sequence(F.lit(0), of_dim - 1)))
    asked = asked.select("dim", "block", "vec_id", "vector").mapInArrow(query_rows, _INDEX)
    parts = max(sum(blocks.values()), int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = index.unionByName(asked).repartition(parts, "dim", "block").sortWithinPartitions("dim", "block", "kind", "seq")
    found = met.mapInArrow(lambda it: searched(it, k, lines, half_width, share), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
