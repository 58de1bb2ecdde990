"""Connected components of an edge table: distributed union-find by alternating stars.

A large star hangs every larger neighbour of a node below the least node near
it, a small star joins a node and its smaller neighbours to the least of them.
Every step is a grouped minimum (combined before the shuffle) and an equi-join
back, so a hub's edges are never gathered; adaptive execution splits the join
of a hot node.  Each round is written to the shared folder, which cuts the
lineage.  Labels converge in a number of rounds logarithmic in the nodes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quireflow.llm.common import materialize


def _near(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a table, and a digest of them taken while they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")), name)
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """node, component (the least node reachable) for every node of an edge table with columns a and b.

    Loops and repeated edges change nothing; nulls are left out.  An empty
    table gives an empty result.  One job a round.  Raises where the labels
    have not settled after ``rounds`` rounds; it never returns part of them.
    """
    own = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u is not null and v is not null")
    tree, before = _written(own.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        both = tree.filter("u != v")
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_near(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _near(large)
        small = large.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        small = small.unionByName(near.filter("u != m").select("u", F.col("m").alias("v"))).distinct()
        tree, after = _written(small, "stars")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    nodes = own.select(F.col("u").alias("node")).union(own.select("v")).distinct()
    found = tree.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("m", "node").alias("component"))


def join_components(label: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The labels of ``components`` after more links a, b: only the components that they touch are joined anew."""
    of = lambda at: label.select(F.col("node").alias(at), F.col("component").alias(f"c{at}"))
    links = found.join(of("a"), "a", "left").join(of("b"), "b", "left")
    links = materialize(links.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), f"{name}-joined")
    over = materialize(components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b"))), f"{name}-over")
    alone = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(label, "node", "left_anti")
    known = label.unionByName(alone.select("node", F.col("node").alias("component")))
    over = over.select(F.col("node").alias("component"), F.col("component").alias("top"))
    return materialize(known.join(over, "component", "left").select("node", F.coalesce("top", "component").alias("component")), f"{name}-labels")


def open_buckets(members: DataFrame, label: DataFrame, tried: DataFrame, name: str) -> DataFrame:
    """key, node, c, lead of the members of buckets in which a pair may still be undecided.

    c is the node's component and lead the component with most members of the
    bucket.  In a bucket of one component nothing is left to find, whatever its
    size, nor in one of two members that were tried.
    """
    named = members.join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    counted = named.groupBy("key", "c").agg(F.count("*").alias("k"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    of = counted.groupBy("key").agg(F.max(F.struct("k", "c")).alias("top"), F.count("*").alias("parts"), F.sum("k").alias("all"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    of = of.filter("parts > 1").select("key", F.col("top.c").alias("lead"), F.when(F.col("all") == 2, F.col("lo")).alias("a"), F.when(F.col("all") == 2, F.col("hi")).alias("b"))
    of = of.join(tried, ["a", "b"], "left_anti").select("key", "lead")
    return materialize(named.join(of, "key").select("key", "node", "c", "lead"), f"{name}-open")


def settle_buckets(members: DataFrame, tried: DataFrame, links: DataFrame, verify: Callable[[DataFrame], DataFrame], across: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """node, component of all nodes with a link, given buckets of candidates.

    members: key, node of every bucket; tried: pairs a < b of every member and
    one other of its bucket; links: what is sure already.  The tried pairs are
    verified first, so a group of near copies costs a bounded number of pairs a
    member.  What is left are the buckets with several components; ``across``
    decides each of their members outside the bucket's largest component
    against all members of other components (rows key, node, c, lead), so no
    link is lost.
    """
    links = materialize(links.select("a", "b").unionByName(verify(tried)), f"{name}-links")
    label = materialize(components(links), f"{name}-labels")
    left = open_buckets(members, label, tried, name)
    if left.isEmpty():
        return label
    found = materialize(across(left), f"{name}-cross")
    return label if found.isEmpty() else join_components(label, found, name)
