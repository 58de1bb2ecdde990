"""The operators against libraries, brute force and planted cases; nulls, empties, repeats and clashing columns."""

import hashlib
import importlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quireflow.llm import bpe, decontam, jaccard, langid, lines, media, quality, queries, sample, substrings, token_counts, toxicity
from quireflow.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASH = ["doc", "key", "node", "part", "kind", "payload", "a", "b", "c", "z", "n", "s", "digest", "score", "y"]
VOCABULARY = [f"w{i}" for i in range(400)]


def docs_of(spark, texts, langs=None, ids=None):
    rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit(7) for c in CLASH})


def prose(rng, n, words=VOCABULARY):
    return " ".join(rng.choice(words) for _ in range(n))


def odd_texts(rng):
    """Null, empty, blank, short, ties, repeats, a very long text and characters of all widths."""
    base = prose(rng, 60)
    return [None, "", " \n\t", "one", "ONE", base, base, base.upper(), "é日本😀 ́Σ\x00\x1c", "x" * 5000, prose(rng, 20_000), base + " end"]


# -- operator 2 ---------------------------------------------------------------
@pytest.fixture(scope="module")
def byte_bpe():
    tokens = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return bpe.ByteBpe(bpe.serialize_model(tokens), P.PATTERN, tokens)


@pytest.fixture(scope="module")
def reference_bpe():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x1c\x85\xa0'sdlver0123")), max_size=60))
def test_bpe_equals_library(byte_bpe, reference_bpe, text):
    ids = byte_bpe.encode(text)
    assert ids == reference_bpe.encode_ordinary(text)
    assert byte_bpe.decode(ids) == text.encode()


def test_bpe_documents(spark, reference_bpe):
    texts = odd_texts(random.Random(1))
    got = {r.doc_id: r for r in bpe.encode_documents(docs_of(spark, texts), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = reference_bpe.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids) == (len(ids), ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(docs_of(spark, texts).limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


# -- operator 6 ---------------------------------------------------------------
@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(json.loads(token_counts.read_spec(P.path("word_bpe_49k.json"))))


@pytest.fixture(scope="module")
def reference_words():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x1c\xa0'sdlverABCΣİ0123<|>")), max_size=50))
def test_counts_equal_library(counter, reference_words, text):
    assert counter.count(text) == len(reference_words.encode(text, add_special_tokens=False).ids)


def test_counts_at_every_prefix(counter, reference_words):
    n = lambda t: len(reference_words.encode(t, add_special_tokens=False).ids)
    text = "Don't we'll thingering 42times -- naïve日本 unbelievableness"
    table = counter.table_of(text)
    for k, piece in enumerate(table.pieces):
        for chars in range(len(piece) + 1):
            assert table.at(k, chars) == n(" ".join([*table.pieces[:k], piece[:chars]]).strip())
    for budget in range(table.total + 2):
        k, chars = table.cut(budget)
        kept = " ".join([*table.pieces[:k], *([table.pieces[k][:chars]] if chars else [])])
        assert n(kept) <= budget
        longer = [" ".join([*table.pieces[:k], table.pieces[k][:c]]) for c in range(chars + 1, len(table.pieces[k]) + 1)] if k < len(table.pieces) else []
        assert all(n(x) > budget for x in longer)


def test_counts_of_documents(spark, reference_words):
    texts = [*odd_texts(random.Random(2)), "a<|endoftext|>b<|startoftext|>"]
    got = {r.doc_id: r for r in token_counts.count_documents(docs_of(spark, texts), P.path("word_bpe_49k.json"), 2048).collect()}
    for i, t in enumerate(texts):
        want = len(reference_words.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), want, want > 2048)


def test_long_words_need_linear_memory(counter, reference_words):
    import resource

    rng = random.Random(22)
    letters = lambda n: "".join(rng.choice("etaoinshrdlu") for _ in range(n))
    n = lambda t: len(reference_words.encode(t, add_special_tokens=False).ids)
    for text in (letters(100_000), "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(12_000)), "ab" * 20_000 + " " + letters(33), letters(32) + " " + letters(64)):
        assert counter.count(text) == n(text)
        assert counter.count(text[: len(text) // 2]) == n(text[: len(text) // 2])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert counter.count(letters(1_000_000)) > 100_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000  # kilobytes


# -- operator 7 ---------------------------------------------------------------
def test_language(spark):
    rng = random.Random(3)
    words = {"aa": ["the", "thing", "with", "other"], "bb": ["une", "que", "leur", "éaux"]}
    langs = [rng.choice(["aa", "bb"]) for _ in range(200)]
    texts = [prose(rng, 40, words[x]) for x in langs]
    df = docs_of(spark, [*texts, None, "", "123 !", texts[0]], [*langs, None, None, "aa", None])
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert all(got[i].lang_pred == x for i, x in enumerate(langs))
    assert [(got[i].lang_pred, got[i].score) for i in (200, 201, 202)] == [("und", 0.0)] * 3
    assert got[203].lang_pred == langs[0] and 0 < got[203].score <= 1
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert langid.keep_identified(df, 0.2).columns == df.columns and langid.keep_identified(df, 0.2).count() == 201
    assert {r.lang_pred for r in langid.identify(df.filter("lang is null")).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_short_texts_have_a_language(spark):
    rng = random.Random(15)
    sounds = {"aa": [c + v for c in "bdfgklmnprst" for v in "aeiou"], "bb": [v + c for c in "chjqvwxyzñßð" for v in "àéîöü"]}
    word = lambda x: "".join(rng.choice(sounds[x]) for _ in range(rng.randint(2, 4)))
    langs = ["aa", "bb"] * 100
    texts = [" ".join(word(x) for _ in range(200)) for x in langs]
    clean = [" ".join(word(x) for _ in range(n)) for n in range(1, 11) for x in ("aa", "bb")]
    junk = ["".join(rng.choice("οπρστυφχψω") for _ in range(400)) for _ in range(10)]
    df = docs_of(spark, [*texts, *clean, *junk], [*langs, *[None] * 30])
    kept = {r.doc_id for r in langid.keep_identified(df, 0.2).select("doc_id").collect()}
    assert kept == set(range(len(texts) + len(clean)))


def test_bundles_are_sums_of_bound_vectors():
    p = langid.Profiles(dimensions=32)
    codes = p.codes("Ab, a")
    want = np.zeros(32)
    for c in codes:
        v = np.ones(32)
        for place in range(3):
            v *= np.roll(p.letters(np.array([c // langid.SYMBOLS**place % langid.SYMBOLS]))[0], place)
        want += v
    assert (p.bundle(["Ab, a"])[0] == want).all() and len(codes) == 4
    assert not p.bundle([None, "12"]).any()


def test_prediction_is_the_largest_cosine(spark):
    rng = random.Random(19)
    words = {"aa": ["the", "thing", "with"], "bb": ["une", "que", "leur"], "ru": ["\u0436\u0443\u043a", "\u043c\u0438\u0440"], "ja": ["\u65e5\u672c", "\u6771\u4eac"]}
    langs = [rng.choice(sorted(words)) for _ in range(120)]
    texts = [prose(rng, 20, words[x]) for x in langs]
    p = langid.Profiles()
    vector = lambda t: sum((p.vectors(np.array([c]))[0].astype(float) for c in p.codes(t)), np.zeros(langid.DIMENSIONS))
    unit = lambda v: v / np.linalg.norm(v)
    learned = {x: unit(sum(unit(vector(t)) for i, (t, y) in enumerate(zip(texts, langs)) if y == x and zlib.crc32(str(i).encode()) % 4 != 2)) for x in sorted(words)}
    got = {r.doc_id: r for r in langid.identify(docs_of(spark, texts, langs)).collect()}
    for i, t in enumerate(texts):
        cosine = {x: float(unit(vector(t)) @ v) for x, v in learned.items()}
        assert got[i].lang_pred == max(cosine, key=cosine.get) and abs(got[i].score - max(cosine.values())) < 1e-4
    long = prose(rng, 60_000, words["aa"])
    assert langid.identify(docs_of(spark, [*texts, long], [*langs, None])).filter("doc_id = 120").first().lang_pred == "aa"


def test_letters_have_vectors_of_their_own():
    p = langid.Profiles()
    rows = p.letters(np.arange(0x4E00, 0x4E00 + 500)).astype(np.float32)
    near = rows @ rows.T / langid.DIMENSIONS - np.eye(len(rows))
    assert abs(near).max() < 0.3 and (p.letters(np.array([97])) == p.letters(np.array([97]))).all()


def test_samples_hold_at_any_size():
    for total in (1, 10, 10**6, 10**11, 10**15):
        share = (sample.hash_bound(6000, total) + 2**63 + 1) / 2**64
        assert abs(share - min(1, 6000 / total)) <= 1e-6 * share
    assert -(2**63) <= sample.hash_bound(1, 10**30) and sample.hash_bound(5, 0) == 2**63 - 1


def test_nothing_to_learn_is_an_error(spark):
    df = docs_of(spark, ["some text", "more text"]).withColumn("lang", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="learn"):
        langid.keep_identified(df, 0.2)
    assert langid.keep_identified(df.limit(0), 0.2).count() == 0


# -- operators 1 and 4 --------------------------------------------------------
def test_quality(spark):
    rng = random.Random(4)
    good = [prose(rng, 80) + "." for _ in range(200)]
    bad = ["!! ".join([prose(rng, 5).upper()] * 12) for _ in range(100)]
    texts = [x for p in zip(good, good[100:] + good[:100], bad + bad) for x in p][:400] + [None, ""]
    y = [0 if "!!" in (t or "") else 1 for t in texts]
    labels = spark.createDataFrame([(i, v, 0) for i, v in enumerate(y[:-2])] + [(None, 1, 0), (5000, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs_of(spark, texts), labels).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert len(held) > 50 and all(got[i].predicted == y[i] for i in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values()) and got[400].score == got[401].score
    empty = labels.limit(0)
    assert {r.score for r in quality.classify(docs_of(spark, texts[:3]), empty).collect()} == {0.5}


def test_additive_tables_are_what_is_scored():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.NAMES))).astype(np.float32)
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) & (x[:, 2] > 0.1)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.9
    one, bins, coarse = 17, model.bins(x[17:18])[0], model.pair_bins(x[17:18])[0]
    by_hand = model.base + sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[coarse[a], coarse[b]] for (a, b), t in zip(model.pairs, model.pair_tables))
    assert abs(by_hand - model.logit(x)[one]) < 1e-9


def test_network_gradients():
    net = toxicity.Network(["a", "b"], -1.0)
    words, index = ["a", "b", "cd"], np.array([[0, 1, 2, 1], [2, 0, 0, 0]])
    mask, y = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool), np.array([1, 0], np.float32)
    none = np.zeros(3, bool)

    def loss():
        logit = net.run(net.projected(net.inputs(words)[0]), index, mask).astype(np.float64)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    g = net.gradients(words, index, mask, y.astype(np.float64), none)
    for k in ("wx", "wh", "b", "att", "out", "bias", "word"):
        flat, at = net.p[k].reshape(-1), int(np.abs(np.asarray(g[k])).reshape(-1).argmax())
        keep = flat[at]
        flat[at] = keep + 1e-3
        up = loss()
        flat[at] = keep - 1e-3
        down = loss()
        flat[at] = keep
        assert abs((up - down) / 2e-3 - np.asarray(g[k]).reshape(-1)[at]) < 2e-3, k


def test_windows_cover_whole_texts():
    for n in range(200):
        starts = toxicity.window_starts(n)
        assert starts[0] == 0 and set(range(n)) <= {s + i for s in starts for i in range(toxicity.WINDOW)}
        assert all(b - a <= toxicity.STRIDE for a, b in itertools.pairwise(starts))


def test_toxicity(spark):
    rng = random.Random(5)
    texts, y = [], []
    for i in range(500):
        words = prose(rng, rng.randint(20, 120)).split()
        y.append(int(i % 3 == 0))
        if y[-1]:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilepig", "vilerat", "vileoaf"]))
        texts.append(" ".join(words))
    texts += [None, "", texts[0] + " " + prose(rng, 4000)]
    labels = spark.createDataFrame([(i, 1, v) for i, v in enumerate(y)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs_of(spark, texts), labels).collect()}
    held = [i for i in range(500) if got[i].held_out]
    assert np.mean([got[i].predicted == y[i] for i in held]) > 0.95
    assert got[500].score == got[501].score < 0.7 and got[502].predicted == 1
    assert {r.score for r in toxicity.classify(docs_of(spark, texts[:2]), labels.filter("toxic = 9")).collect()} == {0.5}


def scored_by_hand(net, text):
    """The network's score of a text, one word and one number at a time."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    sig = lambda x: 1 / (1 + np.exp(-x))
    p, h_ = {k: v.astype(np.float64) for k, v in net.p.items()}, toxicity.HIDDEN

    def vector(w):
        s = f"<{w}>"
        grams = [zlib.crc32(s[i : i + 4].encode()) % toxicity.GRAMS for i in range(max(1, len(s) - 3))]
        return np.concatenate([p["word"][net.ids.get(w, 0)], np.mean([p["gram"][g] for g in grams], 0)])

    def read(way, xs):
        h, out = np.zeros(h_), []
        for x in xs:
            a, u = x @ p["wx"][way] + p["b"][way][0], h @ p["wh"][way]
            z, r = sig(a[:h_] + u[:h_]), sig(a[h_ : 2 * h_] + u[h_ : 2 * h_])
            h = (1 - z) * np.tanh(a[2 * h_ :] + r * u[2 * h_ :]) + z * h
            out.append(h)
        return out

    logits = []
    for at in [0] if len(words) <= 32 else [*range(0, len(words) - 32, 24), len(words) - 32]:
        xs = [vector(w) for w in words[at : at + 32]]
        if not xs:
            return None
        seq = np.concatenate([read(0, xs), read(1, xs[::-1])[::-1]], 1)
        e = np.exp(seq @ p["att"])
        logits.append((e / e.sum()) @ seq @ p["out"] + p["bias"][0])
    return sig(net.slope * max(logits) + net.offset)


def test_scores_are_those_of_the_network():
    rng, net = random.Random(20), toxicity.Network(VOCABULARY[:50], -0.5)
    net.slope, net.offset = 1.3, -0.2
    texts = [prose(rng, n) for n in (1, 5, 31, 32, 33, 56, 57, 200)] + ["日本 été x_y 12 Straße", None, ""]
    texts = [re.sub(r"w(\d+)", lambda m: "".join(chr(97 + int(c)) for c in m[1]), t) if t else t for t in texts]
    net.ids = {"b": 1, "cd": 2, "bcd": 3}
    for t, got in zip(texts, toxicity.Scorer(net)(texts)):
        want = scored_by_hand(net, t)
        assert want is None or abs(got - want) < 1e-4
    assert toxicity.Scorer(net)([None])[0] == toxicity.Scorer(net)([""])[0]


def test_toxic_passages_of_long_texts_are_learned(spark):
    rng = random.Random(21)
    assert toxicity.drawn_windows("a " * 5000, 1, 0) == [" ".join(["a"] * 32)] * 208 and len(toxicity.drawn_windows("a " * 5000, 0, 0)) == 24
    empty = toxicity.classify(docs_of(spark, ["x"]).limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "score", "predicted"]
    df = docs_of(spark, ["😀 \x00", prose(rng, 5), prose(rng, 5), None], ids=[1, 1, 2, None])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for classify in (toxicity.classify, quality.classify):
        assert sorted(str(r.doc_id) for r in classify(df, labels).collect()) == ["1", "1", "2", "None"]
    assert quality.classify(df.limit(0), labels).count() == 0


@pytest.mark.parametrize("make, label, least", [(lambda d, t: quality.classify(d, t), "quality", 0.9), (lambda d, t: toxicity.classify(d, t), "toxic", 0.9)])
def test_held_out_quality_on_the_tables(spark, make, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = make(docs, labels).filter("held_out").join(labels.dropDuplicates(["doc_id"]), "doc_id").select("score", label, "predicted").collect()
    yes, no = (np.array([r.score for r in got if (r[1] > 0) == v]) for v in (True, False))
    auc = np.mean((yes[:, None] > no).astype(float) + 0.5 * (yes[:, None] == no))
    assert auc >= least, auc


def test_held_out_languages_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang").dropDuplicates(["doc_id"]), "doc_id").filter("lang is not null and lang_pred != 'und'")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()


# -- operator 3 ---------------------------------------------------------------
def groups_by_brute_force(texts, n=4, percent=85):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
            lo, hi = sorted((label[i], label[j]))
            label = [lo if x == hi else x for x in label]
    return [len(s) for s in sets], label


def near_copies(rng, bases, copies, most_edits):
    out = []
    for _ in range(bases):
        base = prose(rng, rng.randint(5, 150)).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, most_edits)):
                own[rng.randrange(len(own))] = rng.choice(VOCABULARY)
            out.append(" ".join(own))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_groups(spark, seed):
    rng = random.Random(seed)
    texts = odd_texts(rng) + near_copies(rng, 12, 12, 5)
    sizes, label = groups_by_brute_force(texts)
    got = {r.doc_id: r for r in jaccard.link(docs_of(spark, texts)).collect()}
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == list(zip(sizes, label))


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(6)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        keep = rng.random(len(a)) > rng.choice([0, 0.03, 0.08, 0.15])
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 2**63, int(rng.integers(0, 4))).astype(np.uint64)]))
        if jaccard.similar(a, b):
            assert len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)))
            assert jaccard.Block([2], [2], [b]).links(1, 1, a, 2) == [2]


def test_jaccard_keeps_first(spark):
    texts = ["a b c d e f", None, "A b c d e f", "", "g h", "g h"]
    df = docs_of(spark, texts, ids=[5, 6, 3, 8, None, 9])
    out = jaccard.keep_first(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 3), (False, 6), (False, 8), (True, 0)]
    assert jaccard.link(df.limit(0)).count() == 0


def test_jaccard_with_repeated_and_null_ids(spark):
    rng = random.Random(16)
    base, other, template = prose(rng, 50), prose(rng, 50), prose(rng, 60).split()
    texts = [base, other, base + " x", other + " y", None, "", base, "a b", "A B", prose(rng, 20_000), None]
    ids = [5, 5, 6, 7, 8, 9, None, None, 3, 11, 5]
    for i in range(120):
        words = list(template)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(60)] = rng.choice(VOCABULARY)
        texts.append(" ".join(words))
        ids.append(100 + i // 2)
    sizes, label = groups_by_brute_force(texts)
    for i, j in itertools.combinations(range(len(texts)), 2):  # rows with one id and words are one document
        if ids[i] is not None and ids[i] == ids[j] and sizes[i] and sizes[j] and label[i] != label[j]:
            lo, hi = sorted((label[i], label[j]))
            label = [lo if x == hi else x for x in label]
    least = {x: min((d for d, y in zip(ids, label) if y == x and d is not None), default=None) for x in label}
    want = [(ids[i], sizes[i], least[label[i]] if sizes[i] else ids[i]) for i in range(len(texts))]
    got = jaccard.link(docs_of(spark, texts, ids=ids).repartition(5), parts=7).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(want, key=str)
    assert (6, 48, 5) in want and (7, 48, 5) in want and (None, 47, 5) in want


def test_components_raise_before_they_settle(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    with pytest.raises(RuntimeError, match="settled"):
        components(chain, rounds=1)


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(900, x) for x in range(901, 960)] + [(7, None)]
    label = {x: x for e in edges if None not in e for x in e}
    for _ in label:
        changed = False
        for a, b in edges:
            if b is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            break
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == label


# -- operator 5 ---------------------------------------------------------------
def removals(texts):
    """(words, removed, digest) by looking at every window in order."""
    seen, out = set(), []
    for t in texts:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeats(spark, seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(18, 60)) for _ in range(8)]
    texts = odd_texts(rng) + [" ".join(rng.choice([prose(rng, rng.randint(1, 30)), rng.choice(passages)]) for _ in range(rng.randint(1, 8))) for _ in range(120)] + ["ab " * 70]
    got = {r.doc_id: r for r in substrings.remove_repeats(docs_of(spark, texts), parts=3).collect()}
    assert [(got[i].n_words, got[i].n_removed, got[i].kept_sha256) for i in range(len(texts))] == removals(texts)


def test_repeats_between_tasks_and_ids(spark):
    rng = random.Random(8)
    texts = [prose(rng, 30)] * 6 + [prose(rng, 50)]
    df = docs_of(spark, texts, ids=[4, None, 2, 9, 4, 7, 1]).repartition(5)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.n_removed) for r in substrings.remove_repeats(df, keep_text=True).collect())
    assert got == [((False, 0), 0), ((True, 1), 0), ((True, 2), 30), ((True, 4), 30), ((True, 4), 30), ((True, 7), 30), ((True, 9), 30)]
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_cover_aligns_every_pair():
    p, cover = substrings.PERIOD, substrings.COVER
    assert all(any((i + d) % p in cover and (j + d) % p in cover for d in range(p)) for i in range(p) for j in range(p))


# -- operator 8 ---------------------------------------------------------------
def line_fates(texts, percent=80):
    """First places of the components of lines, by the five-character windows of every pair."""
    place = {}
    for i, t in enumerate(texts):
        for k, x in enumerate((t or "").split("\n") if t is not None else []):
            if x.strip():
                place.setdefault(x, (i, k))
    own = list(place)
    sets = [{x[at : at + 5] for at in range(max(1, len(x) - 4))} for x in own]
    label = list(range(len(own)))
    for i, j in itertools.combinations(range(len(own)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
            lo, hi = sorted((label[i], label[j]))
            label = [lo if x == hi else x for x in label]
    first = {}
    for i, x in enumerate(own):
        first[label[i]] = min(first.get(label[i], (10**9, 0)), place[x])
    return set(first.values())


def test_lines(spark):
    rng = random.Random(9)
    pool = [prose(rng, rng.randint(3, 60)) for _ in range(30)]

    def line():
        words = rng.choice(pool).split()
        for _ in range(rng.choice([0, 0, 0, 1])):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        return " ".join(words)

    texts = [None, "", "\n \n", "same", "same\nsame"] + ["\n".join(line() for _ in range(rng.randint(1, 6))) for _ in range(60)]
    df = docs_of(spark, texts)
    got = {r.doc_id: r for r in lines.line_report(df).collect()}
    kept = {(i, k) for i, r in got.items() for k in r.kept_lines}
    want = line_fates(texts)
    assert want <= kept and len(kept - want) <= 0.03 * len(want)  # bands may miss a pair, the sets never err
    assert [(got[i].n_lines, got[i].n_blank, got[i].n_removed) for i in range(5)] == [(0, 0, 0), (1, 1, 0), (3, 3, 0), (1, 0, 0), (2, 0, 2)]
    out = {r.doc_id: r for r in lines.drop_lines(df).collect()}
    for i, t in enumerate(texts):
        own = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not x.strip() or (i, k) in kept)
        assert out[i].text == own
    assert lines.drop_lines(df).columns == df.columns and lines.line_report(df.limit(0)).count() == 0


def test_long_words_count_whole(spark):
    han = "".join(chr(0x4E00 + 7 * i) for i in range(60))
    apart = ["https://www.example.org/a/1", "https://www.example.org/b/2", "transaction_id=173920001", "transaction_id=846501999", han, han[:16] + "".join(chr(0x6E00 + 5 * i) for i in range(44))]
    near = [han + "\u4e01", "see " + han]
    got = {r.doc_id: r.n_removed for r in lines.line_report(docs_of(spark, [*apart, *near])).collect()}
    assert line_fates([*apart, *near]) == {(i, 0) for i, n in got.items() if not n}
    assert [got[i] for i in range(len(apart))] == [0] * len(apart)
    assert [got[len(apart) + i] for i in range(len(near))] == [1] * len(near)


def test_recall_of_the_least_similar_pairs(spark):
    rng, letters, sizes = random.Random(25), "abcdefghijklmnopqrstuvwxyz日本語éß", [4, 8, 20, 60, 240]
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    texts = [f"{x}\n{x}{text(n // 4)}" for n in sizes for x in (text(n + 4) for _ in range(250))]  # each pair has a similarity of 0.8
    got = {r.doc_id: r.n_removed for r in lines.line_report(docs_of(spark, texts)).collect()}
    found = [sum(got[i] for i in range(k * 250, k * 250 + 250)) for k in range(len(sizes))]
    assert all(0.94 * 250 <= n <= 250 for n in found) and sum(found) >= 0.965 * len(texts), found


def test_groups_of_near_lines(spark):
    rng = random.Random(17)
    template = prose(rng, 60).split()

    def line():
        words = list(template)
        for _ in range(rng.choice([0, 2, 4, 7, 9])):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        return " ".join(words[: rng.choice([60, 60, 60, 45])])

    texts = ["\n".join(line() for _ in range(3)) for _ in range(90)]
    got = {(r.doc_id, k) for r in lines.line_report(docs_of(spark, texts)).collect() for k in r.kept_lines}
    want = line_fates(texts)
    assert 3 < len(want) and want <= got and len(got - want) <= 1


def test_lines_of_odd_documents(spark):
    rng = random.Random(18)
    long = "\n".join(f"{k} {prose(rng, 4)} {k * 7919}" for k in range(5000))
    texts = [None, None, "same line here\nother words in it", "same line here", long, "x" * 100_000, long.split("\n")[4999] + "\n\nnew 😀日本é line of it"]
    ids = [None, 1, 2, 2, 3, 4, None]
    df = docs_of(spark, texts, ids=ids)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_lines, r.n_blank, r.n_removed) for r in lines.line_report(df).collect())
    assert got[:4] == [(False, 0, 0, 0, 0), (False, 0, 3, 1, 0), (True, 1, 0, 0, 0), (True, 2, 1, 0, 0)]
    assert got[4] == (True, 2, 2, 0, 0) and got[6] == (True, 4, 1, 0, 0)  # rows that share a place share its fate
    assert got[5][:4] == (True, 3, 5000, 0) and got[5][4] >= 1
    out = lines.drop_lines(df)
    assert out.columns == df.columns and out.filter("a = 7 and key = 7 and node = 7").count() == len(texts)
    assert lines.drop_lines(df.limit(0)).count() == 0


def test_line_plan_is_native(spark):
    plan = lines.distinct_lines(docs_of(spark, ["a b c"]).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_whole_line_report_is_native(spark, monkeypatch):
    """Every table on the way, pairs of open buckets included, is made without Python."""
    plans, write = {}, lines.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    for module in (lines, importlib.import_module("quireflow.llm.components")):
        monkeypatch.setattr(module, "materialize", noted)
    rng = random.Random(4)
    base = prose(rng, 12)
    texts = [base.replace(base.split()[k], f"{k}{j}") for k in range(6) for j in range(6)] + [f"the report of entry {rng.randrange(10**9)} was closed by {rng.choice('abcdef') * 7} on time" for _ in range(60)]
    monkeypatch.setattr(lines, "SMALL", 8)  # buckets of both kinds
    report = lines.line_report(docs_of(spark, texts).select("doc_id", "text"))
    assert report.count() == len(texts)
    assert {"lines-distinct", "lines-marked", "lines-large", "lines-able"} <= set(plans)
    plans["report"] = report._jdf.queryExecution().executedPlan().toString()
    assert [n for n, p in plans.items() if re.search("Python|Pandas|Arrow", p)] == []


def test_unlike_lines_of_a_bucket_are_not_near(spark):
    rng = random.Random(33)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(120)) for _ in range(200)]
    own = lines.distinct_lines(docs_of(spark, [*texts, texts[0] + "xyz"])).withColumn("k0", lines.F.lit(7).cast("long"))
    own = lines.materialize(own, "lines-distinct")
    doc = {r.node: r.doc for r in own.collect()}
    assert {doc[r.node] for r in lines.near_members(own).collect()} == {0, 200}


def test_band_keys_are_dealt_once(spark, monkeypatch):
    """Buckets with a second member are found in the shuffle that the join reads."""
    plans, write = {}, lines.materialize

    def noted(df, name):
        out = write(df, name)
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(lines, "materialize", noted)
    rng = random.Random(31)
    own = lines.materialize(lines.distinct_lines(docs_of(spark, [prose(rng, 12) for _ in range(40)])), "lines-distinct")
    lines.near_members(own)
    plan = re.sub(r"#\d+L?|(?m:^[ :+-]+)", "", plans["lines-members"])
    dealt = re.findall(r"Exchange hashpartitioning\(key, [^\n]*\n((?:[^\n]*\n){4})", plan)
    assert len(dealt) == 2 and "FileScan" in dealt[0] and dealt[0] == dealt[1], plan  # equal, so one is reused


# -- operator 9 ---------------------------------------------------------------
def test_media(spark, tmp_path):
    texts = odd_texts(random.Random(10))
    uri = f"file://{tmp_path}/media"
    got = {r.doc_id: r for r in media.media_table(docs_of(spark, texts).repartition(3), uri).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        payload = data + b" " * (-len(data) % 192 if data else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        stored = media.ShardReader(uri).read(r.shard, r.offset, r.length)
        assert media.decode_png(stored) == payload and r.media_sha256 == hashlib.sha256(stored).hexdigest() and r.media_bytes == len(stored)
        assert (r.width, r.height) == (64, len(payload) // 192)
    assert got[5].shard == got[6].shard and got[5].offset == got[6].offset and got[5].feature == got[6].feature
    import tarfile

    names = {r.digest for r in got.values()}
    assert names <= {m.name.removesuffix(".png") for p in (tmp_path / "media").iterdir() for m in tarfile.open(p)}
    assert media.media_table(docs_of(spark, texts).limit(0)).count() == 0


# -- operator 10 --------------------------------------------------------------
def least_distance(item, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


def test_edit_matching():
    rng, hits = random.Random(11), 0
    for _ in range(600):
        item = decontam.normalize("".join(rng.choice("abc ") for _ in range(rng.randint(1, 60))))
        if not item:
            continue
        own = list(item)
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(own) + 1)
            own[i : i + rng.randint(0, 1)] = rng.choice(["", "d", "a"])
        text = decontam.normalize("".join([*(rng.choice("abd ") for _ in range(20)), *own, *(rng.choice("abd ") for _ in range(20))]))
        want = least_distance(item, text)
        assert decontam.Pattern(item).best(text) == want
        found = decontam.Matcher([(1, item), (2, item)])(text)
        assert found == ([(1, want), (2, want)] if want <= len(item) // decontam.CHARS_PER_ERROR else [])
        hits += bool(found)
    assert hits > 100


def test_leaks(spark):
    rng = random.Random(12)
    item = prose(rng, 30)
    words = item.split()
    words[3] = words[3] + "x"
    near = "Before\n" + "  ".join(words).upper() + " after"
    texts = [None, "", prose(rng, 100), f"x {item} y", near, prose(rng, 5000)]
    items = spark.createDataFrame([(1, item), (2, None), (3, " "), (4, item), (None, "zz")], "item_id long, text string")
    df = docs_of(spark, texts)
    assert sorted((r.doc_id, r.item_id, r.distance) for r in decontam.find_leaks(df, items).collect()) == [(3, 1, 0), (3, 4, 0), (4, 1, 1), (4, 4, 1)]
    assert sorted(r.doc_id for r in decontam.drop_leaks(df, items).collect()) == [0, 1, 2, 5]
    assert decontam.find_leaks(df, items.limit(0)).count() == 0 and decontam.find_leaks(df.limit(0), items).count() == 0


# -- queries and pipeline -----------------------------------------------------
def test_queries_are_registered():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in queries.queries()} == set(range(1, 11))


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(13)
    item = prose(rng, 30)
    base = prose(rng, 80)
    texts = [base, base.replace(" ", "  ", 1) + " tail", f"{prose(rng, 40)} {item} {prose(rng, 40)}", "123", None, f"first {prose(rng, 30)}\nshared {item[:40]} line here", f"second {prose(rng, 30)}\nshared {item[:40]} line here"] + [prose(rng, 50) for _ in range(20)]
    docs_of(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        df.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert {3, 4}.isdisjoint(kept["language_id"]) and len(kept["language_id"]) == len(texts) - 2
    assert kept["line_dedup"][6].text.startswith("second") and "\n" not in kept["line_dedup"][6].text and "\n" in kept["line_dedup"][5].text
    assert set(kept["line_dedup"]) == set(kept["language_id"]) and kept["line_dedup"][1].text == ""
    assert 2 in kept["jaccard_join"] and 2 not in kept["decontamination"]
    assert set(kept["decontamination"]) == set(kept["jaccard_join"]) - {2}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {i: r.ids_sha256 for i, r in kept["byte_bpe"].items()}


def test_pipeline_on_odd_tables(spark, tmp_path):
    rng = random.Random(23)
    item, base = prose(rng, 30), prose(rng, 80)
    texts = [base, prose(rng, 40), base, None, "", "123", "x" * 50_000, f"{prose(rng, 20)} {item}", base + "\n\n" + prose(rng, 30), prose(rng, 40), "日本 \x00 😀"]
    ids = [1, 1, 2, 3, 4, 5, 6, None, None, 7, 8]
    rows = [(i, t, "en" if k % 2 else None, None, None) for k, (i, t) in enumerate(zip(ids, texts))]
    clash = {c: F.lit(7) for c in ["own", "row", "doc", "same", "key", "node", "score", "later"]}
    names = ["doc_id", "text", "lang", "source", "n_chars", *clash]
    spark.createDataFrame(rows, DOC).withColumns(clash).write.parquet(f"{tmp_path}/full/documents.parquet")
    spark.createDataFrame([(1, item), (None, "y"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/full/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, f"{tmp_path}/full").write.parquet(f"{tmp_path}/full/{k}")
        docs = spark.read.parquet(f"{tmp_path}/full/{k}")
        assert k == 4 or (docs.columns == names and docs.filter("not (row <=> 7)").count() == 0), name
        kept.append(sorted(((r.doc_id or 0) for r in docs.collect())))
    assert kept[0] == [0, 0, 1, 1, 2, 7, 8] and kept[1] == kept[0]  # one letter 50,000 times is no language
    assert spark.read.parquet(f"{tmp_path}/full/1").filter("text = ''").count() == 1  # the line of a null id is the first; rows of doc_id 1 share a place
    assert kept[2] == kept[0] and kept[3] == [0, 1, 1, 2, 7, 8]
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_leaks_of_repeated_rows_and_blocks(spark, monkeypatch):
    rng = random.Random(24)
    items = [(k, prose(rng, 25)) for k in range(12)] + [(3, "another text under a known number for an item")]
    texts = [prose(rng, 20), f"a {items[2][1]} b", f"a {items[2][1]} b", items[11][1].upper(), f"{items[7][1][:-3]}", None]
    df, table = docs_of(spark, texts, ids=[1, 2, 2, None, 4, 5]), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.find_leaks(df, table).collect()), key=str)
    assert [x[:2] for x in whole] == [(2, 2), (2, 2), (4, 7), (None, 11)]
    clean = sorted(str(r.doc_id) for r in decontam.drop_leaks(df, table).collect())
    assert clean == ["1", "5"]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 400)
    assert sorted(map(tuple, decontam.find_leaks(df, table).collect()), key=str) == whole
    assert sorted(str(r.doc_id) for r in decontam.drop_leaks(df, table).collect()) == clean
