"""Registered queries of the operators: thin digests with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm import audit, bpe, decontam, jaccard, langid, lines, media, neighbours, phrases, quality, substrings, token_counts, toxicity
from quireflow.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_documents(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.media_table(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bit_depth", "channels")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=10, inside=50, top=2000)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_byte_bpe, op3_jaccard_join, op4_toxicity, op5_substring_dedup, op6_token_counts, op7_language_id, op8_line_dedup, op9_media_columns, op10_decontamination, op11_nearest_neighbours, op12_phrase_mining, op13_filter_audit)}


#: Words as the contracts of operators 3 and 5 have them.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: Links of all pairs of documents that share a shingle, then the closure of the links.
_JACCARD = rf"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS x FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    l AS MATERIALIZED (SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY p.doc_id, q.doc_id) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
    e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a AS doc_id, min(b) AS b FROM r GROUP BY a)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""

#: Every window of 20 words by its words; those that are not the first of their kind cover what goes.
_REPEATS = rf"""WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    v AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k FROM (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20))),
    g AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 19)) AS p FROM v WHERE k > 1)),
    t AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d)),
    o AS (SELECT t.doc_id, count(*) AS kept, string_agg(x, ' ' ORDER BY t.p) AS own FROM t LEFT JOIN g ON g.doc_id = t.doc_id AND g.p = t.p WHERE g.p IS NULL GROUP BY t.doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(own, '')) AS kept_sha256 FROM d LEFT JOIN o USING (doc_id)"""


#: Phrases of one to three words, the cuts of the frequent ones, and the longer ones that they stand in.
_PHRASES = r"""WITH p AS MATERIALIZED (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    f AS MATERIALIZED (SELECT lang, g, count(*) AS f FROM (SELECT lang, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS g FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k) GROUP BY lang, g),
    n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    c AS MATERIALIZED (SELECT lang, g, f AS a, string_split(g, ' ') AS x FROM f WHERE f >= 10 AND contains(g, ' ')),
    u AS (SELECT lang, g, a, k, array_to_string(x[:k], ' ') AS g1, array_to_string(x[k + 1:], ' ') AS g2 FROM c, (SELECT unnest([1, 2]) AS k) WHERE k < len(x)),
    s AS (SELECT u.lang, u.g, u.a, k, h.f AS l, t.f AS r, (1000000::HUGEINT * u.a * u.a) // (h.f::HUGEINT * t.f) AS score FROM u JOIN f h ON h.lang = u.lang AND h.g = g1 JOIN f t ON t.lang = u.lang AND t.g = g2),
    b AS (SELECT lang, g, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    i AS (SELECT lang, g, max(a) AS a FROM (SELECT lang, array_to_string(x[:2], ' ') AS g, a FROM c WHERE len(x) = 3 UNION ALL SELECT lang, array_to_string(x[2:], ' '), a FROM c WHERE len(x) = 3) GROUP BY lang, g),
    o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, encode(b.g)) AS rank FROM b LEFT JOIN i ON i.lang = b.lang AND i.g = b.g WHERE i.a IS NULL OR 100 * i.a < 50 * b.a)
    SELECT lang, rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o JOIN n USING (lang) WHERE rank <= 2000"""

#: Bits of every document, counted by part and label, held against every step of every order.
_AUDIT = rf"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    b AS (SELECT doc_id, part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS bits FROM t),
    m AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    c AS MATERIALIZED (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS h FROM b LEFT JOIN m USING (doc_id) GROUP BY part, bits),
    f AS (SELECT k, 1 << k AS bit, chr(CAST(65 + k AS INTEGER)) AS letter FROM (SELECT unnest(generate_series(0, 4)) AS k)),
    o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS q FROM f a, f b, f c, f d, f e
        WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
    s AS (SELECT filter_order, step, q[step] AS own, CAST(coalesce(list_sum(q[1:step - 1]), 0) AS BIGINT) AS before FROM o, (SELECT unnest(generate_series(1, 5)) AS step)),
    r AS (SELECT part, filter_order, step, own, sum(CASE WHEN (bits & (own + before)) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN (bits & before) = 0 AND (bits & own) > 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN (bits & before) > 0 AND (bits & own) > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN (bits & before) = 0 AND (bits & own) > 0 THEN g ELSE 0 END) AS good_lost,
        sum(CASE WHEN (bits & before) = 0 AND (bits & own) > 0 THEN h ELSE 0 END) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, own)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
        CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""


def oracle_sql() -> dict[str, str]:
    """SQL of the exact relational operators; the others need a tokenizer, a model, pixels or edit distances, or miss by chance (8)."""
    return {"op3_jaccard_join": _JACCARD, "op5_substring_dedup": _REPEATS, "op12_phrase_mining": _PHRASES, "op13_filter_audit": _AUDIT}
