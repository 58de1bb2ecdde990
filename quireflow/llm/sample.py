"""Bounded samples of labelled rows for training on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 20260102


def hash_bound(want: int, total: int) -> int:
    """The largest 64-bit hash to take so that about ``want`` of ``total`` rows are taken, however many there are."""
    return -(1 << 63) + min(1 << 64, max(1, (want << 64) // max(total, 1))) - 1


def drawn(key: str, seed: int, want: int, total: int) -> Column:
    """True for a share want / total of the keys, chosen by all bits of a hash."""
    return F.xxhash64(key, F.lit(seed)) <= F.lit(hash_bound(want, total))


def labelled(labels: DataFrame, label: str, trainable: Column, rows: int | dict[int, int]) -> list[tuple[int, int]]:
    """(doc_id, label) of about ``rows`` training rows, or as many of each class, chosen by a hash of doc_id.

    Only the two narrow columns are read.  A doc_id labelled more than once
    takes its largest label; rows with a null id or label are not learned from.
    Twice the number of rows is a hard bound on what the driver gets.
    """
    own = labels.filter(trainable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    counts = dict(own.groupBy("y").count().collect())
    total = sum(counts.values())
    out: list[tuple[int, int]] = []
    for y, n in sorted(counts.items()):
        want = rows[y] if isinstance(rows, dict) else max(1, round(rows * n / total))
        out += [(r[0], y) for r in own.filter((F.col("y") == y) & drawn("doc_id", SEED, want, n)).select("doc_id").limit(2 * want).collect()]
    return sorted(out)


def with_text(docs: DataFrame, sample: list[tuple[int, int]]) -> DataFrame:
    """doc_id, text, y of the sampled ids; the sample is broadcast, its size is bounded above."""
    spark = docs.sparkSession
    ids = spark.createDataFrame(sample, "doc_id long, y int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
