"""Phrase mining against a brute force over all phrases, on odd texts and over several chunks."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from quireflow.llm import phrases

DOC = "doc_id long, text string, lang string"


def brute(rows, least, inside, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {x: a for x, a in counts.items() if a >= least and len(x[1]) > 1}
    out = {}
    for (lang, w), a in found.items():
        if any(len(v) > len(w) and lang == g and any(v[i : i + len(w)] == w for i in range(len(v))) and 100 * b >= inside * a for (g, v), b in found.items() if len(w) == 2):
            continue
        cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return [(lang, i + 1, g.decode(), -a, left, right, totals[lang], -s) for lang, own in out.items() for i, (s, a, g, left, right) in enumerate(sorted(own)[:top])]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["alpha", "Beta", "é", "日本", "x1", "--", "the", "THE", "\x0bz"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! ", "\r\n"]) for _ in range(n))
    out = [(i, text(rng.randrange(60)), rng.choice(["en", "de", None, "und", ""])) for i in range(120)]
    out += [(200, None, "en"), (201, "", "fr"), (202, " \t", "fr"), (203, text(20_000), "en"), (None, "new york city new york", "en"), (205, "go go go go go go go go go go go go", "fr")]
    return out + [(206, "new york city " * 3 + "\x00 a", "en")] * 10


@pytest.mark.parametrize(("least", "inside", "top", "size"), [(10, 50, 2000, None), (3, 80, 15, 2000)])
def test_collocations_are_brute_force(spark, rows, monkeypatch, least, inside, top, size):
    if size:  # chunks of few texts, in several rows
        own = phrases.chunks_of

        def small(batches):
            phrases.CHUNK_TEXT, phrases.ROW_PLACES = size, 100
            return own(batches)

        monkeypatch.setattr(phrases, "chunks_of", small)
    docs = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(7) for c in ("chunk", "kind", "key", "word", "n", "id", "level", "m", "p", "part", "rank")}).repartition(3)
    got = sorted(map(tuple, phrases.collocations(docs, least, inside, top).collect()))
    assert got == sorted(brute(rows, least, inside, top))
    assert got


def test_collocations_of_nothing(spark, rows):
    docs = spark.createDataFrame(rows, DOC)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("doc_id in (200, 201, 202)")).count() == 0


def test_scores_pass_64_bits(spark):
    big = 10**14 + 7
    row = spark.createDataFrame([(big, big + 5, 3 * big)], "a long, l long, r long").select(phrases.floored_score("a", "l", "r")).first()
    assert row[0] == 10**6 * big * big // ((big + 5) * 3 * big)


def test_counts_are_dealt_packed():
    rng = np.random.default_rng(3)
    texts, counts, dealt = [], Counter(), []
    for chunk in (5, 9):
        words = rng.integers(0, 40, 3000).astype("<i4")
        words[::50] = -1
        counts.update((int(a), int(b)) for a, b in zip(words[:-1], words[1:], strict=True) if a >= 0 and b >= 0)
        texts.append(words)
        rows = [{"chunk": chunk, "level": 0, "keys": None, "ids": None, "seq": 0, "codes": words.tobytes()}, {"chunk": chunk, "level": 1, "keys": list(range(40)), "ids": list(range(40)), "seq": None, "codes": None}]
        kinds = {"chunk": pa.int64(), "level": pa.int32(), "keys": pa.list_(pa.int64()), "ids": pa.list_(pa.int64()), "seq": pa.int32(), "codes": pa.binary()}
        dealt.append(phrases.extended(pa.Table.from_pylist(rows, pa.schema(kinds.items())), 2, 4))
    dealt = pa.concat_tables(dealt)
    assert dealt.num_rows == 8  # a row for each bucket and chunk, not one for each pair
    found, back = {}, {}
    for bucket in range(4):
        for r in phrases.summed(dealt.filter(pc.equal(dealt["bucket"], bucket)), 2, 4).to_pylist():
            if r["f"] is None:
                back.setdefault(r["chunk"], []).extend(np.frombuffer(r["keys"], "<i8").tolist())
            else:
                found[r["key"] >> 32, r["key"] & 0xFFFFFFFF] = r["f"]
    assert found == {k: n for k, n in counts.items() if n >= 4} and found
    for chunk, words in zip((5, 9), texts, strict=True):
        assert sorted(back[chunk]) == sorted({int(a) << 32 | int(b) for a, b in zip(words[:-1], words[1:], strict=True) if a >= 0 and b >= 0 and (a, b) in found})
