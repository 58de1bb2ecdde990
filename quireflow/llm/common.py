"""Helpers shared by the operators: shared storage, batches, splits, word hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch and text bytes handled at once; both only bound memory.
ARROW_ROWS = 500
CHUNK_BYTES = 4_000_000
#: Text bytes whose hashes one task of an index holds at once.
RANGE_BYTES = 128_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent, a local master uses a folder of this machine and
    sets it as the session's checkpoint folder; on a cluster that would lose
    results, so it raises.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file://" + os.path.join(tempfile.gettempdir(), "quireflow-shared")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation
    of what stood before.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranges(docs: DataFrame) -> int:
    """How many ranges of hashes an index over these texts is dealt to: one for RANGE_BYTES, the session's partitions at least."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to a size that fits small Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def crc_split(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text has this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


#: Keys of rows with a null doc_id: NULL_SPAN values from NULL_ID on, below every doc_id in use.
NULL_ID, NULL_SPAN = -(2**63), 2**40


def known_id(doc_id: Column, text: Column) -> Column:
    """doc_id as a key; rows without one come before all others and are told apart, and spread, by a hash of their text."""
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_ID) + F.pmod(F.xxhash64(text), F.lit(NULL_SPAN)))


def shown_id(key: Column) -> Column:
    """The doc_id of a key, null for rows without one."""
    return F.when(key >= NULL_ID + NULL_SPAN, key)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about CHUNK_BYTES of text (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(text))), 0)
        cum = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < n:
            base = cum[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(cum, base + CHUNK_BYTES, side="right")))
            yield batch.slice(start, end - start)
            start = end


_MASK = (1 << 64) - 1
#: Odd multipliers of the mixing steps (the finaliser of splitmix64).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of byte words, remembered for the words met most recently."""

    def __init__(self, seed: int = 0, most: int = 300_000):
        self.seed, self.most, self.known = seed, most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > self.most:
                known.clear()
                new = set(words)
            h, seed = xxhash.xxh3_64_intdigest, self.seed
            for w in new:
                known[w] = h(w, seed)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words, from the words' hashes."""
    k = len(h) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(k, n, np.uint64)
        for j in range(n):
            out = mix(out * np.uint64(0xD1342543DE82EF95) + h[j : j + k])
        return out
