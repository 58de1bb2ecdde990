"""Fuzzy line dedup by MinHash (operator 8), in DataFrame functions alone.

A line's set holds the hashes of all its windows of SHINGLE characters (code
points), one at every position; a shorter line is one window.  The windows of
all lines are exploded inside one generated stage and folded by a grouped
minimum into VALUES MinHashes a line, the j-th by ``(a + j * b) mod 2**32``
from the halves a, b of a window's hash.  The values lie in a square of ROWS x
ROWS; its rows, columns and diagonals are the bands.  Lines that share a band
are candidates if four bits of every MinHash agree often enough, the sets of
the lines decide, and of each component of similar lines the first (least
doc_id, then line) stays.  Equal lines are one node from the start.

Each member of a bucket is verified against one drawn from the bucket, another
one in every band.  After union-find, the members outside the largest
component of their bucket are verified against its other components: in a small
bucket (SMALL) all of them, sizes, parity marks and sets being compared in the join's
condition; in a large one those with which they share one of their rarest
windows, as similar sets do.

Defined results: blank lines are no candidates and always stay; a null text has
no lines, an empty one has one blank line; lines of rows with a null doc_id
come before all others, by a hash of the row's text; rows that share a doc_id
(or have none and share the text) and a line number share the line's fate.  Lines are what stands between line feeds.  Columns of other names
pass through, whatever they are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import known_id, materialize, shown_id
from quireflow.llm.components import settle_buckets

SHINGLE = 5
PERCENT = 80
ROWS = 5
VALUES = ROWS * ROWS
#: Values of each band: rows, columns and diagonals of the square; two bands share one value at most.
BANDS = [
    *([ROWS * r + c for c in range(ROWS)] for r in range(ROWS)),
    *([ROWS * r + c for r in range(ROWS)] for c in range(ROWS)),
    *([ROWS * r + (c + r) % ROWS for r in range(ROWS)] for c in range(ROWS)),
]
KEYS = [f"k{b}" for b in range(len(BANDS))]
#: Bits of each MinHash that are kept, and how many a long holds.
SAMPLE = 4
PACKED = 64 // SAMPLE
#: Of VALUES four-bit samples at least so many agree in a candidate pair; at the least similarity 20 are expected.
AGREE = 16
#: Members drawn from its buckets that a line is verified against before union-find.
TRIED = 4
#: Members of a bucket that are all held against each other; larger ones go by rare windows.
SMALL = 8
#: Longs of parity marks, and cells in which windows are counted.
MARKS = 16
CELLS = 1 << 17
#: Longs of the map of wanted places.
WORDS = 1 << 19
#: Bytes of a character in the encoding that is cut into windows.
_WIDE, _ENCODING = 4, "UTF-32"


def _doc(df: DataFrame) -> DataFrame:
    return df.select(known_id(F.col("doc_id"), F.col("text")).alias("doc"), "text")


def _starts(line: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.length(line) - SHINGLE, F.lit(0)))


def _window(encoded: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(encoded, start * _WIDE + 1, F.lit(SHINGLE * _WIDE)))


def shingle_hashes(line: Column) -> Column:
    """Distinct hashes of all windows of a line."""
    # a lambda binds the encoded line, which is made once and not once a window
    return F.transform(F.array(F.encode(line, _ENCODING)), lambda e: F.array_distinct(F.transform(_starts(line), lambda i: _window(e, i))))[0]


def split_lines(docs: DataFrame) -> DataFrame:
    """doc, ln, line of every line that is not blank."""
    return _doc(docs).select("doc", F.posexplode(F.split("text", "\n")).alias("ln", "line")).filter(F.col("line").rlike(r"\S"))


def minhashes(lines: DataFrame) -> DataFrame:
    """h1, h2 and the MinHashes m0, m1, ... of every distinct line."""
    windows = lines.select("h1", "h2", F.encode("line", _ENCODING).alias("e"), _starts(F.col("line")).alias("starts"))
    hashed = windows.select("h1", "h2", "e", F.explode("starts").alias("i")).select("h1", "h2", _window(F.col("e"), F.col("i")).alias("x"))
    low = F.lit(0xFFFFFFFF)
    halves = hashed.select("h1", "h2", F.shiftrightunsigned("x", 32).alias("a"), F.col("x").bitwiseAND(low).bitwiseOR(F.lit(1)).alias("b"))
    return halves.groupBy("h1", "h2").agg(*(F.min((F.col("a") + F.lit(j) * F.col("b")).bitwiseAND(low)).alias(f"m{j}") for j in range(VALUES)))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """node, h1, h2 (the line), doc, ln (its first place), bits (SAMPLE of each MinHash) and the band keys KEYS of every distinct line."""
    lines = split_lines(docs).select("doc", "ln", "line", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(8)).alias("h2"))
    place = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc", "ln")).alias("place"))
    sample = lambda j: F.shiftleft(F.col(f"m{j}").bitwiseAND(F.lit((1 << SAMPLE) - 1)), SAMPLE * (j % PACKED))
    bits = F.struct(*(reduce(Column.bitwiseOR, map(sample, range(at, min(at + PACKED, VALUES)))).alias(f"b{at}") for at in range(0, VALUES, PACKED)))
    keys = [F.xxhash64(F.lit(b), *(F.col(f"m{j}") for j in band)).alias(name) for b, (band, name) in enumerate(zip(BANDS, KEYS, strict=True))]
    both = minhashes(lines).join(place, ["h1", "h2"])
    return both.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "place.*", bits.alias("bits"), *keys)


def agree(x: Column, y: Column) -> Column:
    """How many samples agree."""

    def differ(name: str) -> Column:
        d = x[name].bitwiseXOR(y[name])
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    return F.lit(VALUES) - reduce(Column.__add__, (differ(f"b{at}") for at in range(0, VALUES, PACKED)))


def near_members(lines: DataFrame) -> DataFrame:
    """key, node, bits of the members of buckets that are near another member of the bucket.

    The keys are dealt once: the buckets with a second member are found in the
    same rows, node and its check for null included, that the join reads, so that
    both share a shuffle.
    """
    keys = lines.filter("node is not null").select("node", F.explode(F.array(*KEYS)).alias("key")).repartition("key")
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    members = materialize(keys.join(shared.hint("shuffle_hash"), "key").join(lines.select("node", "bits"), "node"), "lines-members")
    other = members.select(F.col("key").alias("okey"), F.col("node").alias("onode"), F.col("bits").alias("obits"))
    met = (F.col("key") == F.col("okey")) & (F.col("node") != F.col("onode")) & (agree(F.col("bits"), F.col("obits")) >= AGREE)
    return materialize(members.join(other, met, "left_semi"), "lines-near")


def drawn_others(members: DataFrame) -> DataFrame:
    """node, others: up to TRIED members drawn from each member's buckets.

    Each bucket draws one member.  Of those drawn for a node the first ones by
    hash are tried, which joins a group of near copies around few members, and
    the nearest one.
    """
    drawn = members.groupBy("key").agg(F.min(F.struct(F.col("node").bitwiseXOR(F.col("key")).alias("x"), "node", "bits")).alias("one"))
    met = members.join(drawn.select("key", "one"), "key").withColumn("alike", agree(F.col("bits"), F.col("one.bits")))
    met = met.filter((F.col("node") != F.col("one.node")) & (F.col("alike") >= AGREE))
    one = F.collect_set(F.struct(F.xxhash64("one.node").alias("h"), F.col("one.node").alias("other"), "alike"))  # at most one a band
    of = met.groupBy("node").agg(F.array_sort(one).alias("drawn"))
    nearest = F.array_max(F.transform("drawn", lambda x: F.struct(x["alike"], x["other"].alias("other"))))["other"]
    others = F.array_union(F.transform(F.slice("drawn", 1, TRIED - 1), lambda x: x["other"]), F.array(nearest))
    return of.select("node", others.alias("others"))


def _cell() -> Column:
    return F.pmod(F.xxhash64("doc", "ln"), F.lit(64 * WORDS))


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(_cell(), F.lit(64)).cast("int"))


def places_seen(wanted: DataFrame) -> DataFrame:
    """One row: a map of bits (column words) in which the cell of every wanted place is set.  Its size is fixed."""
    words = wanted.groupBy(F.shiftright(_cell(), 6).alias("w")).agg(F.bit_or(_bit()).alias("bits"))
    every = wanted.sparkSession.range(WORDS).select(F.col("id").alias("w")).join(words, "w", "left")
    rows = F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(rows, lambda x: x["bits"]).alias("words"), F.lit(1).alias("one"))


def texts_of(docs: DataFrame, lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, line, n (size of the set) of some distinct lines.

    Lines whose place can't be wanted stay out of the shuffle; the join decides.
    """
    wanted = materialize(lines.join(nodes, "node").select("node", "doc", "ln", "h1", "h2"), "lines-wanted")
    own = split_lines(docs).withColumn("one", F.lit(1)).join(F.broadcast(places_seen(wanted)), "one")
    own = own.filter(F.get("words", F.shiftright(_cell(), 6).cast("int")).bitwiseAND(_bit()) != 0).select("doc", "ln", "line")
    out = own.join(wanted, ["doc", "ln"]).filter((F.xxhash64("line") == F.col("h1")) & (F.xxhash64("line", F.lit(8)) == F.col("h2")))
    one = out.select("doc", "ln", "node", "line").dropDuplicates(["doc", "ln", "node"])
    return one.select("node", "line").withColumn("n", F.size(shingle_hashes(F.col("line"))))


def _similar(a: str, b: str) -> list[Column]:
    """Conditions under which the lines of two sides are similar, the cheap one first."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    both = F.size(F.array_intersect(shingle_hashes(F.col(f"line{a}")), shingle_hashes(F.col(f"line{b}"))))
    return [F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT, both * (100 + PERCENT) >= (na + nb) * PERCENT]


def similar_lines(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("line").alias(f"line{x}"), F.col("n").alias(f"n{x}"))
    size, sets = _similar("a", "b")
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(size).filter(sets).select("a", "b")


def parity_marks(sets: DataFrame) -> DataFrame:
    """node, marks: MARKS longs of parities of a set s; as many bits differ between two sets as they have odd cells, at most their differing hashes."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright("t", 8), F.lit(64)).cast("int"))
    mark = lambda k: F.coalesce(F.bit_xor(F.when(F.pmod("t", F.lit(MARKS)) == k, bit)), F.lit(0).cast("long"))
    return sets.select("node", F.explode("s").alias("t")).groupBy("node").agg(F.array(*(mark(k) for k in range(MARKS))).alias("marks"))


def marks_near() -> Column:
    """Whether the marks of two sides leave it open that they are similar."""
    differ = reduce(Column.__add__, (F.bit_count(F.col("marksa")[k].bitwiseXOR(F.col("marksb")[k])) for k in range(MARKS)))
    return differ * (100 + PERCENT) <= (F.col("na") + F.col("nb")) * (100 - PERCENT)


def seen_counts(sets: DataFrame) -> DataFrame:
    """One row: how many windows (column s) fall into each of CELLS cells.  Its size is fixed."""
    cell = F.pmod(F.col("t"), F.lit(CELLS)).alias("cell")
    cells = sets.select(F.explode("s").alias("t")).groupBy(cell).agg(F.count("*").alias("k"))
    every = sets.sparkSession.range(CELLS).select(F.col("id").alias("cell")).join(cells, "cell", "left")
    rows = F.array_sort(F.collect_list(F.struct("cell", F.coalesce("k", F.lit(0)).alias("k"))))
    return every.agg(F.transform(rows, lambda x: x["k"]).alias("counts"), F.lit(1).alias("one"))


def prefixes(sets: DataFrame) -> DataFrame:
    """The rows of ``sets`` (s, n and more) once for each of their rarest windows t, with its place ``at`` from 1.

    All sets are put into one order, rare windows first.  Of two similar sets
    the first ``n - least common part + 1`` windows share one, so what doesn't
    meet there can't be similar; windows that many lines share stand last and
    bring nobody together.
    """
    own = sets.withColumn("one", F.lit(1)).join(F.broadcast(seen_counts(sets)), "one")
    rare = F.array_sort(F.transform("s", lambda t: F.struct(F.get("counts", F.pmod(t, F.lit(CELLS)).cast("int")).alias("k"), t.alias("t"))))
    least = F.ceil(F.col("n") * PERCENT / F.lit(100)).cast("int")
    first = F.slice(rare, F.lit(1), F.col("n") - least + 1)
    rest = [c for c in sets.columns if c != "s"]
    return own.select(*rest, F.posexplode(first).alias("at", "x")).select(*rest, (F.col("at") + 1).alias("at"), F.col("x.t").alias("t"))


def across_lines(left: DataFrame, texts: DataFrame, lines: DataFrame, drawn: DataFrame) -> DataFrame:
    """Links between components in open buckets (key, node, c, lead).

    Members that no member of another component is near, but for the ones they
    were tried with, go first.  Of the others those outside their bucket's
    largest component are held against its other components: all of them in a
    bucket of at most SMALL members, in a larger one those that share a rare
    window, so a bucket of many unlike lines costs about as much as it has lines.
    """
    sketch = texts.select("node", "n").join(lines.select("node", "bits"), "node")
    light = left.join(sketch, "node").join(drawn, "node", "left").withColumn("others", F.coalesce("others", F.array().cast("array<long>")))
    light = materialize(light, "lines-light")
    size = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * PERCENT
    other = light.select(*(F.col(c).alias(f"o{c}") for c in ("key", "node", "c", "n", "bits", "others")))
    met = (F.col("key") == F.col("okey")) & (F.col("c") != F.col("oc")) & size(F.col("n"), F.col("on")) & (agree(F.col("bits"), F.col("obits")) >= AGREE)
    met &= ~F.array_contains("others", F.col("onode")) & ~F.array_contains("oothers", F.col("node"))
    left = materialize(light.join(other, met, "left_semi").select("key", "node", "c", "lead", "bits"), "lines-apart")
    small = F.col("members") <= SMALL
    sized = left.join(left.groupBy("key").agg(F.count("*").alias("members")), "key")
    few, many = sized.filter(small).drop("members", "bits"), sized.filter(~small).drop("members")
    return in_small_buckets(few, texts, lines).unionByName(in_large_buckets(many, texts)).distinct()


def in_large_buckets(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of members (key, node, c, lead, bits) that share one of their rarest windows."""
    left = left.groupBy("node").agg(F.min("c").alias("c"), F.bool_or(F.col("c") != F.col("lead")).alias("own"), F.min("bits").alias("bits"))
    sets = texts.join(left, "node").withColumn("s", shingle_hashes(F.col("line"))).drop("line")
    sets = materialize(sets, "lines-large")
    rare = prefixes(sets)
    side = lambda x: rare.select("t", *(F.col(c).alias(f"{c}{x}") for c in ("node", "c", "n", "at", "bits", "own")))
    own, other = side("a").filter("owna").drop("owna"), side("b")
    once = (F.col("ca") != F.col("cb")) & (~F.col("ownb") | (F.col("nodea") < F.col("nodeb")))
    # what both can share: windows before this one, itself, and those after it
    room = F.least("ata", "atb") + F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))
    able = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT) & (room * (100 + PERCENT) >= (F.col("na") + F.col("nb")) * PERCENT)
    found = own.join(other, (own["t"] == other["t"]) & once & able & (agree(F.col("bitsa"), F.col("bitsb")) >= AGREE))
    pairs = materialize(found.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct(), "lines-able")
    marks = parity_marks(sets).join(sets.select("node", "n"), "node")
    mark = lambda x: marks.select(*(F.col(c).alias(x if c == "node" else f"{c}{x}") for c in marks.columns))
    return similar_lines(pairs.join(mark("a"), "a").join(mark("b"), "b").filter(marks_near()).select("a", "b"), texts)


def in_small_buckets(left: DataFrame, texts: DataFrame, lines: DataFrame) -> DataFrame:
    """Links of members (key, node, c, lead) outside the lead with those of other components, in the first bucket that two share.

    The join's condition verifies them, so a pair becomes a row only if it is a
    link.  A pair whose first shared bucket is a large one meets there.
    """
    nodes = left.select("node").distinct()
    own = texts.join(nodes, "node", "left_semi")
    marks = parity_marks(own.select("node", shingle_hashes(F.col("line")).alias("s")))
    marked = own.join(marks, "node").join(lines.select("node", *KEYS), "node")
    marked = materialize(marked.select("node", "line", "n", "marks", F.array(*KEYS).alias("keys")), "lines-marked")
    named = left.join(marked, "node").withColumn("band", F.array_position("keys", F.col("key")))
    side = lambda x: named.select("key", "lead", *(F.col(c).alias(f"{c}{x}") for c in ("node", "c", "line", "n", "marks", "keys", "band")))
    own, other = side("a").filter("ca != lead").drop("lead"), side("b")
    able, sets = _similar("a", "b")
    once = (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("lead")) | (F.col("nodea") < F.col("nodeb")))
    first = reduce(Column.__and__, ((F.col("banda") <= k + 1) | (F.col("keysa")[k] != F.col("keysb")[k]) for k in range(len(KEYS) - 1)))
    found = own.join(other, (own["key"] == other["key"]) & once & able & marks_near() & first & sets)
    return found.select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")).distinct()


def keepers(docs: DataFrame) -> DataFrame:
    """doc, ln of the lines that stay: the first line of each component."""
    lines = materialize(distinct_lines(docs), "lines-distinct")
    members = near_members(lines)
    drawn = materialize(drawn_others(members), "lines-drawn")
    pairs = drawn.select("node", F.explode("others").alias("other"))
    tried = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    texts = materialize(texts_of(docs, lines, members.select("node").distinct()), "lines-texts")
    label = settle_buckets(members.select("key", "node"), tried, tried.limit(0), lambda pairs: similar_lines(pairs, texts), lambda left: across_lines(left, texts, lines, drawn), "lines")
    named = lines.select("node", "doc", "ln").join(label, "node", "left")
    place = F.min(F.struct("doc", "ln")).alias("place")
    linked = named.filter("component is not null").groupBy("component").agg(place).select("place.*")
    return named.filter("component is null").select("doc", "ln").unionByName(linked)


def kept_numbers(docs: DataFrame) -> DataFrame:
    """doc, kept: the numbers of the lines that stay, for documents that keep any candidate."""
    return keepers(docs).groupBy("doc").agg(F.sort_array(F.collect_set("ln")).alias("kept"))


def _numbers(lines: Column) -> Column:
    """Numbers of the lines that are not blank."""
    return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(r"\S"), i)), lambda i: i.isNotNull())


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_blank, n_removed, kept_lines (numbers of lines that stay, blank ones left out) of each row."""
    none = F.array().cast("array<int>")
    own = _doc(docs).select("doc", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n"), F.coalesce(_numbers(F.split("text", "\n")), none).alias("own"))
    out = own.join(kept_numbers(docs), "doc", "left").withColumn("kept_lines", F.array_intersect("own", F.coalesce("kept", none)))
    n_lines = F.greatest("n", F.lit(0))
    return out.select(shown_id(F.col("doc")).alias("doc_id"), n_lines.alias("n_lines"), (n_lines - F.size("own")).alias("n_blank"), (F.size("own") - F.size("kept_lines")).alias("n_removed"), "kept_lines")


def _only_kept(text: Column, kept: Column) -> Column:
    """The text with the lines numbered in kept and the blank ones; linear in the number of lines."""

    def of(lines: Column) -> Column:
        blank = F.filter(F.transform(lines, lambda x, i: F.when(~x.rlike(r"\S"), i)), lambda i: i.isNotNull())
        stay = F.sort_array(F.array_union(blank, F.coalesce(kept, F.array().cast("array<int>"))))
        return F.array_join(F.filter(F.transform(stay, lambda i: F.get(lines, i)), lambda x: x.isNotNull()), "\n")

    return F.when(text.isNotNull(), F.transform(F.array(F.split(text, "\n")), of)[0])


def drop_lines(docs: DataFrame) -> DataFrame:
    """The rows of documents, all columns, with only the lines that stay in text and n_chars (where there is one) to match."""
    kept = kept_numbers(docs).select(F.struct("doc", "kept").alias("own"))
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    doc = known_id(F.col("row.doc_id"), F.col("row.text"))
    both = row.join(kept, doc == F.col("own.doc"), "left").withColumn("text", _only_kept(F.col("row.text"), F.col("own.kept")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return both.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
