"""Filter interaction audit: what every order of a set of filters would remove, by part of the corpus.

A document's failures are one bit a filter.  All but one follow from its own
text.  The last, that its text stands in a document of smaller id as well, is
existential: a left-semi join on hash, exact text and smaller id, whose other
side has one row for each repeated text, so a text that a third of all rows
share costs each of them one comparison and is split like any skewed join.
The ids it marks are united with those of the other failures, counted by part,
bit combination and label, and the counts alone decide all orders: what a
sequence of filters leaves is the sum over the combinations without any of
their bits.

Null texts count as empty.  A row without an id is never smaller than another
and has no smaller one, so it never fails the last filter; repeated rows (one
id, one text) don't fail it by each other.  Rows that share an id are rows of
their own; an id labelled more than once has its largest labels.  An empty
table gives no row.  Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import materialize

#: Letters of the filters; the last is the existential one.
FILTERS = "ABCDE"
#: Limits of the filters by text.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5


def text_failures(text: Column) -> Column:
    """Bits of filters A to D of a text that is not null: few words, repeated words, capitals, marks."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    own = F.struct(F.size(words).cast("long").alias("n"), F.size(F.array_distinct(words)).cast("long").alias("kinds"))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    few = own["n"] < LEAST_WORDS
    alike = 100 * own["kinds"] < LEAST_DISTINCT * own["n"]
    loud = 100 * capitals > MOST_CAPITALS * F.length(text)
    marked = text.rlike("[#$%&*|]")
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate((few, alike, loud, marked))), F.lit(0))


def repeated_texts(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, h and what else ``docs`` has) whose text stands in a row of smaller doc_id.

    Only rows whose hash repeats bring their text to the join.
    """
    own = docs.withColumn("h", F.xxhash64("text"))
    spread = own.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    spread = materialize(spread.select("h"), "audit-repeated")  # a table, so that a hot hash can be split in the join
    twins = materialize(own.join(spread, "h", "left_semi"), "audit-twins")
    firsts = twins.groupBy("h", "text").agg(F.min("doc_id").alias("first")).alias("f")
    same = (F.col("t.h") == F.col("f.h")) & (F.col("t.text") == F.col("f.text")) & (F.col("f.first") < F.col("t.doc_id"))
    return twins.alias("t").join(firsts, same, "left_semi")


def failing_rows(docs: DataFrame) -> DataFrame:
    """doc_id, part, bits, n for every combination of failures that rows of one id have."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    bits = text_failures(F.col("text")).alias("bits")
    every = own.select("doc_id", "part", bits, F.lit(1).alias("n"), F.lit(0).alias("e"))
    twice = repeated_texts(own).select("doc_id", "part", bits, F.lit(0).alias("n"), F.lit(1).alias("e"))
    ids = every.unionByName(twice).groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    with_last = F.struct((F.col("bits") + (1 << len(FILTERS) - 1)).alias("bits"), F.col("e").alias("n"))
    without = F.struct(F.col("bits"), (F.col("n") - F.col("e")).alias("n"))
    return ids.select("doc_id", "part", F.explode(F.array(without, with_last)).alias("x")).select("doc_id", "part", "x.bits", "x.n").filter("n > 0")


def steps(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, bit of the step's filter, bits of the filters before it) of every step of every order."""
    out = []
    for order in itertools.permutations(range(len(filters))):
        before = 0
        for at, k in enumerate(order):
            out.append(("".join(filters[i] for i in order), at + 1, 1 << k, before))
            before |= 1 << k
    return out


def shapley(k: int, n: int = len(FILTERS)) -> str:
    """Removals of filter k summed over all orders: after each set of other filters, as often as an order begins with that set."""
    terms = []
    for s in range(1 << n):
        if not s >> k & 1:
            often = math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count())
            terms.append(f"{often} * (every[{s}] - every[{s | 1 << k}])")
    return " + ".join(terms)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the step, for every part, order and step.

    kept and removed count documents after and at the step; redundant those
    that fail its filter and went before; unique_fails those that fail no other
    filter; good_lost and toxic_lost removed ones of these labels; shapley the
    filter's removals summed over all orders.
    """
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("bad"))
    seen = failing_rows(docs).join(marks, "doc_id", "left").groupBy("part", "bits", "good", "bad").agg(F.sum("n").alias("n"))
    full = (1 << len(FILTERS)) - 1
    kinds = {"every": F.lit(True), "good": F.col("good"), "bad": F.col("bad")}
    free = F.col("bits").bitwiseAND(F.col("s")) == 0
    left = seen.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(full)))).groupBy("part", "s")
    left = left.agg(*(F.sum(F.when(free & own, F.col("n")).otherwise(0)).alias(kind) for kind, own in kinds.items()))
    # for each part, what each set of filters leaves, in the order of the sets
    parts = left.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("s", *kinds))).alias("x")).select("part", *(F.col("x")[kind].alias(kind) for kind in kinds))
    parts = parts.withColumn("worth", F.expr(f"array({', '.join(shapley(k) for k in range(len(FILTERS)))})"))
    lit = F.lit(json.dumps([dict(zip(("filter_order", "step", "own", "before"), x, strict=True)) for x in steps()]))
    row = F.from_json(lit, "array<struct<filter_order:string,step:int,own:int,before:int>>")
    return parts.select("*", F.inline(row)).selectExpr(
        "part",
        "filter_order",
        "step",
        "every[own + before] as kept",
        "every[before] - every[own + before] as removed",
        "every[0] - every[own] - every[before] + every[own + before] as redundant",
        f"every[{full} - own] - every[{full}] as unique_fails",
        "good[before] - good[own + before] as good_lost",
        "bad[before] - bad[own + before] as toxic_lost",
        "worth[cast(log2(own) as int)] as shapley",
    )
