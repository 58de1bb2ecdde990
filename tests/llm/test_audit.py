"""The filter audit against a brute force over all orders, on tables with nulls, repeats and clashing columns."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quireflow.llm import audit

DOC = "doc_id long, text string, lang string, source string"


def brute(rows, labels):
    """The counts of every part, order and step, by going through the documents filter by filter."""
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            old = marks.get(i, (0, 0))
            marks[i] = (max(old[0], quality or 0), max(old[1], toxic or 0))
    fails = []
    for i, text, _, source in rows:
        x = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        own = set()
        own |= {"A"} if len(w) < 50 else set()
        own |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", x)) > 5 * len(x) else set()
        own |= {"D"} if re.search(r"[#$%&*|]", x) else set()
        own |= {"E"} if i is not None and any(j is not None and j < i and (t or "") == x for j, t, _, _ in rows) else set()
        fails.append((source or "", own, marks.get(i, (0, 0))))
    out = {}
    for part in {p for p, _, _ in fails}:
        here = [(f, m) for p, f, m in fails if p == part]
        worth = Counter()
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, k in enumerate(order, 1):
                gone = [x for x in left if k in x[0]]
                left = [x for x in left if k not in x[0]]
                worth[k] += len(gone)
                failing = sum(k in f for f, _ in here)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(f == {k} for f, _ in here), sum(m[0] == 1 for _, m in gone), sum(m[1] == 1 for _, m in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(worth[order[step - 1]])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, clean = prose(30_000), " ".join(words[:80])
    texts = [None, "", " \n\t", "one", "ONE", clean, clean, clean, clean.upper(), clean + " #", "é日本😀 Σ", "x" * 5000, long, long, prose(60), "A b", "A b"]
    out = [(i, t, "en", rng.choice([None, "", "s", "t"])) for i, t in enumerate(texts)]
    return out + [(None, clean, "en", "s"), (None, clean, "en", "s"), (5, clean, "en", "s"), (3, "again", None, "t")]


def test_audit_is_brute_force(spark, rows):
    labels = [(i, rng, i % 2) for i, rng in zip(range(17), [1, 0, 1] * 6, strict=False)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (999, 1, 1)]
    docs = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(7) for c in ("h", "bits", "part", "n", "e", "s", "first", "lo", "hi", "good", "step")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("q"))
    got = {tuple(r)[:3]: list(tuple(r)[3:]) for r in audit.audit(docs, marks).collect()}
    assert got == brute(rows, labels)
    assert len(got) == 600 * 3


def test_audit_of_nothing(spark, rows):
    docs, marks = spark.createDataFrame(rows, DOC), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs.limit(0), marks).count() == 0
    assert {r.good_lost for r in audit.audit(docs, marks).collect()} == {0}


def test_audit_of_a_text_most_rows_share(spark):
    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.step: r for r in audit.audit(copies, marks).filter("filter_order = 'EABCD'").collect()}
    assert (got[1].removed, got[1].kept, got[2].removed, got[2].redundant) == (999, 2001, 2001, 999)
