"""Nearest neighbours against brute force: recall, exact scores, ties, and vectors that take no part."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.llm import neighbours, queries

VEC = "vec_id long, embedding array<double>, label int"


def brute(rows, is_query, k):
    """query_id: [(vec_id, score)] of the k largest inner products, ties to the smaller id; rows of one id are their least vector."""
    kept = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        kept[i] = min(kept.get(i, v), v)
    out = {}
    for q in filter(is_query, kept):
        own = [(j, float((np.array(kept[q]) * np.array(v)).sum())) for j, v in kept.items() if j != q and len(v) == len(kept[q])]
        out[q] = sorted(own, key=lambda x: (-x[1], x[0]))[:k]
    return {q: x for q, x in out.items() if x}


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    want, got = brute(rows, lambda i: i % 20 == 0, 20), result(queries.op11_nearest_neighbours(spark, f"/root/testdata/{sf}"))
    assert {q: len(x) for q, x in want.items()} == {q: len(x) for q, x in got.items()}
    hits = sum(len({j for j, _ in want[q]} & {j for j, _ in got[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, found in got.items():
        exact = dict(found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(exact[j] - s) < 1e-12 for j, s in want[q] if j in exact)


def test_many_blocks_of_unequal_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.standard_normal(24) * rng.choice([0.1, 1, 30])], 0) for i in range(3000)]
    df = spark.createDataFrame(rows, VEC).repartition(5)
    want, got = brute(rows, lambda i: i % 50 == 0, 10), result(neighbours.nearest(df, F.col("vec_id") % 50 == 0, k=10, block=500))
    hits = sum(len({j for j, _ in want[q]} & {j for j, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    near = lambda: [float(x) for x in np.eye(8)[0] + 0.01 * rng.standard_normal(8)]
    same = near()
    rows = [(i, same, 0) for i in range(0, 600)]  # copies: every rank is a tie
    rows += [(1000 + i, near(), 0) for i in range(30)]
    rows += [(None, same, 0), (2000, None, 0), (2020, [], 0), (2040, [0.0] * 8, 0), (2060, [*same[:7], None], 0), (2080, [*same[:7], math.nan], 0), (2100, [*same[:7], math.inf], 0)]
    rows += [(3000, [1.0, 2.0, 3.0], 0), (3001, [0.5, 0.5, 0.5], 0), (3020, [1e200, 0.0], 0), (3021, [1e-200, 1e-200], 0), (4000, [-x for x in same], 0)]
    rows += [(40, near(), 0), (7, same, 0), (7, same, 0), (4020, [5.0], 0)]
    df = spark.createDataFrame(rows, VEC).withColumns({c: F.lit("x") for c in ("dim", "block", "kind", "seq", "vector", "rank", "score", "query_id")})
    want, got = brute(rows, lambda i: i % 20 == 0, 20), result(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, block=300))
    assert want.keys() == got.keys()
    assert {q: [j for j, _ in x] for q, x in got.items() if q < 600 and q != 40} == {q: [j for j, _ in x] for q, x in want.items() if q < 600 and q != 40}
    assert got[3000] == want[3000]
    assert got[3020] == want[3020]
    assert 4020 not in got
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
