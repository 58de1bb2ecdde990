"""Named queries over the driver's tables and the SQL that gives the same rows.

The tables stand in for pages, judgments and recognised text: documents and
parts for page geometry, events for judges' answers, conversations for the
ordered parts of a group, labels for sparse judgments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.config import Dewarp, Integration, Ocr, Settings, overlay
from quireflow.functions import coerce, geometry, names, parsing
from quireflow.operators import images, integration, judgments, recognition, routing, summaries, tiles
from quireflow.plans import stages, stand_ins, whole
from quireflow.sinks import committed, outputs
from quireflow.sources import pdf, scans, texts

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- integration of text ------------------------------------------------------
_STRIPPED = r"(SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations)"


@query(f"""SELECT conv_id, count(*) AS files_count, string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY turn) AS integrated_text,
    CAST(length(string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY turn)) AS INTEGER) AS total_characters
    FROM {_STRIPPED} WHERE t <> '' GROUP BY conv_id""")
def integrate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integration.integrate(table(spark, sf_dir, "conversations"), ["conv_id"], [F.col("turn")])


@query(f"""SELECT conv_id, string_agg(t, chr(10) ORDER BY turn) AS integrated_text FROM {_STRIPPED} WHERE t <> '' GROUP BY conv_id""")
def integrate_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = integration.integrate(table(spark, sf_dir, "conversations"), ["conv_id"], [F.col("turn")], cfg=Integration(include_separators=False))
    return out.select("conv_id", "integrated_text")


@query(f"""WITH g AS (SELECT role, conv_id, count(*) AS n, length(string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY turn)) AS c
    FROM {_STRIPPED} WHERE t <> '' GROUP BY role, conv_id)
    SELECT role, count(*) AS groups, CAST(sum(n) AS BIGINT) AS files, CAST(sum(c) AS BIGINT) AS total_characters, round(sum(c) / count(*), 6) AS average_text_length FROM g GROUP BY role""")
def integrate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = integration.integrate(table(spark, sf_dir, "conversations"), ["role", "conv_id"], [F.col("turn")])
    out = own.groupBy("role").agg(F.count("*").alias("groups"), F.sum("files_count").alias("files"), F.sum("total_characters").alias("total_characters"))
    return out.withColumn("average_text_length", F.round(summaries.ratio(F.col("total_characters"), F.col("groups")), 6))


@query(f"""WITH g AS (SELECT conv_id, role, count(*) AS n, length(string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY turn)) AS c
      FROM {_STRIPPED} WHERE t <> '' AND role IN ('user', 'assistant') GROUP BY conv_id, role),
    w AS (SELECT conv_id, coalesce(sum(n) FILTER (role = 'user'), 0) AS user_files, coalesce(sum(c) FILTER (role = 'user'), 0) AS user_characters,
      coalesce(sum(n) FILTER (role = 'assistant'), 0) AS assistant_files, coalesce(sum(c) FILTER (role = 'assistant'), 0) AS assistant_characters FROM g GROUP BY conv_id)
    SELECT conv_id, CAST(user_files AS BIGINT) AS user_files, CAST(user_characters AS BIGINT) AS user_characters, CAST(assistant_files AS BIGINT) AS assistant_files,
      CAST(assistant_characters AS BIGINT) AS assistant_characters, CAST(user_characters > 0 AS INTEGER) + CAST(assistant_characters > 0 AS INTEGER) AS output_files,
      2 - CAST(user_characters > 0 AS INTEGER) - CAST(assistant_characters > 0 AS INTEGER) AS total_errors, (user_characters > 0 OR assistant_characters > 0) AS success FROM w""")
def integration_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").filter(F.col("role").isin("user", "assistant")).withColumn("engine", F.col("role"))
    return integration.integration_summary(integration.integrate(own, ["conv_id", "engine"], [F.col("turn")]), ("user", "assistant"), ("conv_id",))


@query("""SELECT role AS session_id, role || '_integrated' AS stem, CAST(count(*) AS BIGINT) AS files_count, CAST(sum(length(text)) AS BIGINT) AS total_characters,
    'llm_integrated_' || role || '.txt' AS llm_file FROM conversations GROUP BY role""")
def metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").groupBy(F.col("role").alias("session_id")).agg(F.count("*").alias("files_count"), F.sum(F.length("text")).alias("total_characters"))
    body = own.withColumn("j", outputs.metadata_json(F.struct("files_count", "total_characters")))
    get = lambda k: F.get_json_object("j", f"$.{k}")
    return body.select(get("session_id").alias("session_id"), F.concat(get("session_id"), F.lit("_integrated")).alias("stem"), get("integration_summary.files_count").cast("long").alias("files_count"), get("integration_summary.total_characters").cast("long").alias("total_characters"), get("output_files.llm_integrated").alias("llm_file"))


# -- groups and engines -------------------------------------------------------
def _tiles_of_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("role") == "system", "original").otherwise("split")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("int").alias("page_number"), (F.col("turn") % 2).cast("int").alias("source_mask_index"), kind.alias("image_type"), F.col("turn").cast("int").alias("split_index"), F.concat(F.lit("t"), "turn").alias("image_path"), "text")


@query("""SELECT printf('page_%03d_mask%d', conv_id, turn % 2 + 1) AS group_key, CAST(conv_id AS INTEGER) AS page_number, CAST(turn % 2 AS INTEGER) AS source_mask_index, CAST(count(*) AS INTEGER) AS images,
    CAST(count(*) FILTER (role <> 'system') AS INTEGER) AS strips, string_agg('t' || turn, ',' ORDER BY (role <> 'system')::INT, turn) AS image_order FROM conversations GROUP BY conv_id, turn % 2""")
def ocr_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tiles.ocr_groups(_tiles_of_conversations(spark, sf_dir))
    strips = F.size(F.filter("images", lambda x: x["image_type"] == "split"))
    return out.select("group_key", "page_number", "source_mask_index", F.size("images").alias("images"), strips.alias("strips"), F.array_join(F.transform("images", lambda x: x["image"]), ",").alias("image_order"))


@query("""SELECT conv_id, string_agg(text, '|' ORDER BY turn) FILTER (role = 'user') AS user_text, string_agg(text, '|' ORDER BY turn) FILTER (role = 'assistant') AS assistant_text
    FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id""")
def engine_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("group_key"), F.col("role").alias("engine")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "|").alias("extracted_text"))
    out = routing.compare_engines(own, "user", "assistant")
    return out.select(F.col("group_key").alias("conv_id"), F.col("user").alias("user_text"), F.col("assistant").alias("assistant_text"))


@query(r"""SELECT conv_id, CAST(count(*) AS BIGINT) AS processed_images, CAST(count(*) FILTER (turn % 5 <> 4) AS BIGINT) AS successful_images, CAST(count(*) FILTER (turn % 5 = 4) AS BIGINT) AS failed_images,
    round(coalesce(avg(CASE WHEN turn % 5 <> 4 THEN length(text) / 1000.0::DOUBLE END), 0), 6) AS average_confidence,
    coalesce(string_agg(CASE WHEN turn % 5 <> 4 AND regexp_replace(text, '^\s+|\s+$', '', 'g') <> '' THEN regexp_replace(text, '^\s+|\s+$', '', 'g') END, chr(10) || chr(10) ORDER BY turn), '') AS combined_text FROM conversations GROUP BY conv_id""")
def document_ai_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").withColumns({"success": F.col("turn") % 5 != 4, "confidence": F.length("text") / F.lit(1000.0)})
    out = summaries.document_ai_group(own, ["conv_id"], "turn")
    return out.select("conv_id", "processed_images", "successful_images", "failed_images", F.round("average_confidence", 6).alias("average_confidence"), "combined_text")


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS total_groups, CAST(count(*) FILTER (event_id % 7 <> 0) AS BIGINT) AS successful_groups, CAST(count(*) FILTER (event_id % 7 = 0) AS BIGINT) AS failed_groups,
    round(coalesce(avg(CASE WHEN event_id % 7 <> 0 AND value - 20 > 0 THEN value - 20 END), 0), 6) AS overall_confidence,
    round(100.0::DOUBLE * count(*) FILTER (event_id % 7 <> 0) / count(*), 6) AS success_rate, CAST(sum(CASE WHEN event_id % 7 <> 0 THEN length(props) ELSE 0 END) AS BIGINT) AS total_text_length FROM events GROUP BY event_type""")
def positive_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 7 != 0).alias("success"), F.greatest(F.lit(0.0), F.col("value") - 20).alias("average_confidence"), F.col("props").alias("combined_text"), F.lit(1).alias("processed_images"), F.lit(1).alias("successful_images"), F.lit(0).alias("failed_images"))
    out = summaries.document_ai_summary(own, ("event_type",))
    return out.select("event_type", "total_groups", "successful_groups", "failed_groups", F.round("overall_confidence", 6).alias("overall_confidence"), F.round("success_rate", 6).alias("success_rate"), "total_text_length")


@query("""SELECT user_id, round(coalesce(avg(value), 0), 6) AS confidence FROM events GROUP BY user_id""")
def token_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list("value").alias("c"))
    return own.select("user_id", F.round(summaries.token_confidence(F.col("c")), 6).alias("confidence"))


@query("""SELECT role, CAST(count(*) AS BIGINT) AS total_groups, CAST(count(*) FILTER (turn % 3 <> 2) AS BIGINT) AS successful_groups, CAST(coalesce(sum(length(text)) FILTER (turn % 3 <> 2), 0) AS BIGINT) AS total_text_length,
    CAST(coalesce(sum(turn) FILTER (turn % 3 <> 2), 0) AS BIGINT) AS total_images_processed, round(coalesce(sum(length(text)) FILTER (turn % 3 <> 2), 0) / greatest(1, count(*) FILTER (turn % 3 <> 2)), 6) AS average_text_length FROM conversations GROUP BY role""")
def ocr_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("role", (F.col("turn") % 3 != 2).alias("success"), F.col("text").alias("extracted_text"), F.col("turn").alias("processed_images"))
    return summaries.ocr_summary(own, ("role",)).select("role", "total_groups", "successful_groups", "total_text_length", "total_images_processed", F.round("average_text_length", 6).alias("average_text_length"))


@query("""WITH g AS (SELECT conv_id, bool_or(role = 'assistant') AS ok FROM conversations GROUP BY conv_id)
    SELECT CAST(count(*) AS BIGINT) AS total_groups, CAST(count(*) FILTER (ok) AS BIGINT) AS successful_groups, count(*) FILTER (ok) * 100.0::DOUBLE / greatest(count(*), 1) AS success_rate FROM g""")
def extraction_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.extraction_status(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("group_key"), (F.col("role") == "assistant").alias("success")))


# -- geometry -----------------------------------------------------------------
_STRIPS = """(SELECT doc_id, h, n, CAST(floor(h / n) AS INT) AS base, CAST(floor(floor(h / n) * 0.1::DOUBLE) AS INT) AS ov FROM
    (SELECT doc_id, n_chars AS h, CASE WHEN n_chars // 5 < 100 THEN greatest(1, n_chars // 100) ELSE 5 END AS n FROM documents))"""
_REGIONS = f"""(SELECT doc_id, i, n, CAST(greatest(0, i * base - ov) AS INT) AS s, CAST(CASE WHEN i = n - 1 THEN h ELSE least(h, (i + 1) * base + ov) END AS INT) AS e
    FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM {_STRIPS}))"""


@query(f"SELECT doc_id, CAST(i AS INTEGER) AS region, s AS start_y, e AS end_y FROM {_REGIONS}")
def strip_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(geometry.strip_regions(F.col("n_chars"))).alias("region", "r"))
    return out.select("doc_id", "region", F.col("r.start").alias("start_y"), F.col("r.end").alias("end_y"))


@query(f"""SELECT doc_id, CAST(i AS INTEGER) AS region, CAST(length(c) AS INTEGER) AS n_chars, md5(c) AS chunk_md5 FROM
    (SELECT r.doc_id, i, substr(d.text, s + 1, e - s) AS c FROM {_REGIONS} r JOIN documents d USING (doc_id))""")
def overlap_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents").select("doc_id", "text", F.posexplode(geometry.strip_regions(F.col("n_chars"))).alias("region", "r"))
    chunk = F.substring(F.col("text"), F.col("r.start") + 1, F.col("r.end") - F.col("r.start"))
    return out.select("doc_id", "region", F.length(chunk).alias("n_chars"), F.md5(chunk).alias("chunk_md5"))


@query(f"""SELECT doc_id, image_type, CAST(k AS INTEGER) AS split_index, CAST(n AS INTEGER) AS split_total, s AS start_y, e AS end_y FROM
    (SELECT doc_id, 'split' AS image_type, i + 1 AS k, n, s, e FROM {_REGIONS}
     UNION ALL SELECT doc_id, 'original', 0, n, 0, CAST(h AS INT) FROM {_STRIPS})""")
def tile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tile_records(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), F.col("n_chars")).drop("n_chars")


@query(f"""SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS total_pages, CAST(count(*) AS BIGINT) AS total_split_images, CAST(count(DISTINCT doc_id) AS BIGINT) AS total_source_images,
    count(*) / count(DISTINCT doc_id)::DOUBLE AS average_splits_per_page FROM {_REGIONS}""")
def tiling_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = tiles.tile_records(table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("source_mask_index"), "n_chars"), F.col("n_chars"))
    return tiles.tiling_summary(own, "doc_id")


@query(f"""SELECT lang, CAST(count(*) AS BIGINT) AS split_count, CAST(count(DISTINCT source) AS BIGINT) AS source_count FROM {_REGIONS} r JOIN documents USING (doc_id) GROUP BY lang""")
def page_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("lang", F.col("source").alias("source_mask_index"), "n_chars")
    return tiles.page_tiles(tiles.tile_records(own, F.col("n_chars")), ["lang"]).drop("tiles")


@query("""SELECT doc_id, side, s AS start_x, e AS end_x FROM
    (SELECT doc_id, 'left' AS side, 0 AS s, CAST(n_chars // 2 + CAST(floor(n_chars * 0.1::DOUBLE) AS INT) // 2 AS INT) AS e FROM documents WHERE doc_id % 3 = 0
     UNION ALL SELECT doc_id, 'right', CAST(n_chars // 2 - CAST(floor(n_chars * 0.1::DOUBLE) AS INT) // 2 AS INT), CAST(n_chars AS INT) FROM documents WHERE doc_id % 3 = 0
     UNION ALL SELECT doc_id, 'whole', 0, CAST(n_chars AS INT) FROM documents WHERE doc_id % 3 <> 0)""")
def spread_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.when(F.col("doc_id") % 3 == 0, 2).otherwise(1).alias("page_count"), F.lit(None).cast("boolean").alias("skip_processing"))
    return stages.split_spreads(own, "n_chars").select("doc_id", "side", "start_x", "end_x")


_DPI = "CASE WHEN w <= 0 OR h <= 0 THEN 300 ELSE CAST(trunc(greatest(50.0::DOUBLE, least(600.0::DOUBLE, least(2048 * 72.0::DOUBLE / w, 2560 * 72.0::DOUBLE / h)))) AS INTEGER) END"
_PART = "(SELECT p_partkey, p_size * 24.0::DOUBLE AS w, p_retailprice AS h, p_size FROM part)"
_SIDE = lambda c, d: f"CAST(trunc({c} * {d} / 72.0::DOUBLE) AS INTEGER)"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * F.lit(24.0)).alias("w"), F.col("p_retailprice").alias("h"), "p_size")


@query(f"SELECT p_partkey, dpi, {_SIDE('w', 'dpi')} AS width, {_SIDE('h', 'dpi')} AS height, round(dpi / 72.0::DOUBLE, 9) AS zoom FROM (SELECT *, {_DPI} AS dpi FROM {_PART})")
def optimal_dpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _parts(spark, sf_dir).withColumn("dpi", geometry.optimal_dpi(F.col("w"), F.col("h")))
    size = geometry.output_size(F.col("w"), F.col("h"), F.col("dpi"))
    return own.select("p_partkey", "dpi", size["width"].alias("width"), size["height"].alias("height"), F.round(geometry.zoom_factor(F.col("dpi")), 9).alias("zoom"))


@query(f"""SELECT p_partkey, level, d AS dpi, {_SIDE('w', 'd')} AS width, {_SIDE('h', 'd')} AS height, round(d / 72.0::DOUBLE, 9) AS zoom FROM
    (SELECT *, 'min' AS level, 50 AS d FROM {_PART} UNION ALL SELECT *, 'optimal', {_DPI} FROM {_PART} UNION ALL SELECT *, 'default', 300 FROM {_PART} UNION ALL SELECT *, 'max', 600 FROM {_PART})""")
def dpi_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _parts(spark, sf_dir)
    return own.select("p_partkey", F.inline(geometry.dpi_levels(F.col("w"), F.col("h")))).withColumn("zoom", F.round("zoom", 9))


@query(f"SELECT p_partkey, dpi AS used_dpi, greatest(50, least(600, dpi * 2)) AS new_dpi FROM (SELECT *, {_DPI} AS dpi FROM {_PART}) WHERE p_size % 3 = 0")
def rescaled_dpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("p_size") % 3 == 0, "Major").otherwise("minor")
    own = _parts(spark, sf_dir).withColumn("dpi", geometry.optimal_dpi(F.col("w"), F.col("h"))).filter(routing.needs_rerender(F.lit(True), level))
    return own.select("p_partkey", F.col("dpi").alias("used_dpi"), geometry.scaled_dpi(F.col("dpi")).alias("new_dpi"))


@query("""SELECT p_partkey, d AS dpi, CASE WHEN d * d * 8.5::DOUBLE > 10000000 THEN 600 ELSE d END AS capped, (d BETWEEN 50 AND 600) AS valid, greatest(50, least(600, d)) AS suggested FROM (SELECT p_partkey, p_size * 40 AS d FROM part)""")
def memory_capped_dpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 40).alias("dpi"))
    return own.select("p_partkey", "dpi", geometry.memory_capped_dpi(F.col("dpi")).alias("capped"), F.inline(F.array(geometry.dpi_verdict(F.col("dpi")))))


# -- parsing and coercion -----------------------------------------------------
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@query(r"""SELECT event_id, CAST(json_extract_string(regexp_extract(a, '```json\s*(.*?)\s*```', 1, 's'), '$.k') AS INTEGER) AS k FROM
    (SELECT event_id, 'answer:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```' || ' end' AS a FROM events)""")
def fence_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("answer:\n```json\n"), "props", F.lit("\n``` end")).alias("a"))
    return own.select("event_id", F.get_json_object(parsing.judgment_json(F.col("a")), "$.k").cast("int").alias("k"))


@query(f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN event_type WHEN 2 THEN 'plain ' || event_type WHEN 3 THEN '{{"extracted_text": "' || event_type
      ELSE '{{' || chr(10) || '  "k": ' || {_K} || chr(10) || '}}' END AS extracted_text,
    CASE event_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 4 THEN 'no_field' ELSE 'not_json' END AS note FROM events""")
def ocr_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = F.concat(F.lit('{"extracted_text": "'), "event_type")
    kind = F.col("event_id") % 5
    answer = F.when(kind == 0, F.concat(F.lit("```json\n"), field, F.lit('"}\n```'))).when(kind == 1, F.concat(F.lit("so "), field, F.lit('"} it is'))).when(kind == 2, F.concat(F.lit(" plain "), "event_type", F.lit("\n"))).when(kind == 3, field).otherwise(F.col("props"))
    return parsing.parse_ocr(table(spark, sf_dir, "events").select("event_id", answer.alias("response"))).select("event_id", "extracted_text", "note")


_BUCKET = "CASE WHEN d BETWEEN -45 AND 45 THEN 0 WHEN d > 45 AND d <= 135 THEN 90 WHEN d >= -135 AND d < -45 THEN -90 ELSE 180 END"


@query(f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN {_BUCKET} WHEN 1 THEN {_BUCKET} WHEN 2 THEN 90 ELSE 0 END AS angle FROM (SELECT event_id, {_K} * 4 - 200 AS d FROM events)""")
def angle_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.get_json_object("props", "$.k").cast("int") * 4 - 200
    kind = F.col("event_id") % 4
    body = F.when(kind == 0, F.concat(F.lit('{"recommended_angle": '), d, F.lit("}"))).when(kind == 1, F.concat(F.lit('{"rotation_angle": "about '), d, F.lit(' 度"}'))).when(kind == 2, F.lit('{"recommended_angle": "右90", "rotation_angle": 180}')).otherwise(F.lit('{"recommended_angle": null, "rotation_angle": 90}'))
    return table(spark, sf_dir, "events").select("event_id", parsing.judged_angle(body).alias("angle"))


@query(f"""SELECT CASE WHEN event_id % 6 = 0 THEN NULL ELSE {_BUCKET} END AS angle, CAST(count(*) AS BIGINT) AS n FROM (SELECT event_id, {_K} * 4 - 200 AS d FROM events) GROUP BY 1""")
def angle_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.get_json_object("props", "$.k").cast("int") * 4 - 200
    own = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 6 != 0, parsing.angle_bucket(d)).alias("a"))
    return summaries.histogram(own, F.col("a"), name="angle")


_VALUES = "(SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'false' WHEN 3 THEN '123.45' WHEN 4 THEN '-1.9' WHEN 5 THEN ' 7 ' WHEN 6 THEN '' WHEN 7 THEN 'yes' ELSE NULL END AS v FROM events)"


@query(f"""SELECT event_id, coalesce(v IN ('true', ' TRUE '), false) AS b, coalesce(v IN ('true', ' TRUE ', ''), false) AS b_compat,
    CASE v WHEN '123.45' THEN 123 WHEN '-1.9' THEN -1 WHEN ' 7 ' THEN 7 ELSE 999 END AS i, CASE v WHEN '123.45' THEN 123.45 WHEN '-1.9' THEN -1.9 WHEN ' 7 ' THEN 7.0 END::DOUBLE AS f,
    coalesce(v IN ('true', 'yes'), false) AS judge_b, CASE v WHEN ' 7 ' THEN 7 END AS judge_i FROM {_VALUES}""")
def coerce_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.element_at(F.array(*map(F.lit, ["true", " TRUE ", "false", "123.45", "-1.9", " 7 ", "", "yes", None])), (F.col("event_id") % 9 + 1).cast("int"))
    own = table(spark, sf_dir, "events").select("event_id", v.alias("v"))
    c = F.col("v")
    return own.select("event_id", coerce.to_bool(c).alias("b"), coerce.to_bool(c, compat=True).alias("b_compat"), coerce.to_int(c, 999).alias("i"), coerce.to_double(c).alias("f"), coerce.judge_bool(c).alias("judge_b"), coerce.judge_int(c).alias("judge_i"))


@query("""SELECT doc_id, 'scan_' || doc_id AS stem, printf('scan_%d_page_%03d.jpg', doc_id, doc_id) AS page_image, printf('page_%03d_mask%d', doc_id, doc_id % 4 + 1) AS group_key,
    '/in_rot/scan_' || doc_id || '_rot.jpg' AS rotated, CASE doc_id % 3 WHEN 0 THEN 'image/png' WHEN 1 THEN 'application/pdf' ELSE 'image/jpeg' END AS media_type FROM documents""")
def names_and_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.element_at(F.array(F.lit(".PNG"), F.lit(".pdf"), F.lit(".jpg")), (F.col("doc_id") % 3 + 1).cast("int"))
    own = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.concat(F.lit("/in_rot/scan_"), "doc_id", end).alias("path"))
    p, d = F.col("path"), F.col("doc_id")
    return own.select("doc_id", names.stem(p).alias("stem"), names.page_image_name(p, d).alias("page_image"), names.group_key(d, d % 4).alias("group_key"), names.with_suffix(p).alias("rotated"), names.media_type(p).alias("media_type"))


@query(r"""SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM conversations WHERE turn % 2 = 0 UNION ALL SELECT conv_id, turn, text FROM conversations WHERE turn % 2 = 1""")
def saved_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("turn") % 2 == 0
    own = table(spark, sf_dir, "conversations").withColumns({"path": F.when(even, "a_ocr_result.TXT").otherwise("a.json"), "content": F.when(even, F.concat(F.lit("head: x\n----------\n\n"), "text", F.lit("\n "))).otherwise(F.to_json(F.struct(F.struct(F.col("text").alias("extracted_text")).alias("ocr_result"))))})
    return own.select("conv_id", "turn", texts.saved_text(F.col("path"), F.col("content")).alias("body"))


# -- judgments ----------------------------------------------------------------
_LEVEL = "CASE event_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'Minor' WHEN 2 THEN 'MAJOR' ELSE 'odd' END"
_MERGE = f"""SELECT user_id, CAST(count(*) AS BIGINT) AS images, CAST(count(*) FILTER (ok) AS BIGINT) AS successful_images, coalesce(bool_or(tbl) FILTER (ok), false) AS has_table_elements,
    coalesce(bool_or(hand) FILTER (ok), false) AS has_handwritten_notes_or_marks, CAST(least(3, greatest(1, coalesce(sum(pc) FILTER (ok), 0))) AS INTEGER) AS page_count, round(avg(conf) FILTER (ok), 3) AS confidence_score,
    CASE coalesce(max(CASE lower(lvl) WHEN 'none' THEN 0 WHEN 'minor' THEN 1 WHEN 'major' THEN 2 END) FILTER (ok), 0) WHEN 0 THEN 'none' WHEN 1 THEN 'minor' ELSE 'major' END AS readability_issues,
    string_agg(CASE WHEN ok THEN 'img' || i || ': ' || event_type END, chr(10) ORDER BY i) AS overall_comment, true AS success
    FROM (SELECT user_id, event_id, event_type, event_id % 11 <> 0 AS ok, event_type = 'error' AS tbl, event_type = 'view' AS hand, CASE WHEN event_id % 5 = 0 THEN NULL ELSE {_K} % 3 - 1 END AS pc, round(value) / 1024 AS conf,
      {_LEVEL} AS lvl, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events) GROUP BY user_id"""


@query(_MERGE)
def merge_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    level = F.element_at(F.array(*map(F.lit, ["none", "Minor", "MAJOR", "odd"])), (e % 4 + 1).cast("int"))
    own = table(spark, sf_dir, "events").select(
        "user_id", "event_id", (e % 11 != 0).alias("success"), F.when(F.col("event_type") == "error", "True").otherwise("False").alias("has_table_elements"), F.when(F.col("event_type") == "view", "yes").otherwise("off").alias("has_handwritten_notes_or_marks"),
        F.when(e % 5 == 0, "2.0").otherwise((F.get_json_object("props", "$.k").cast("int") % 3 - 1).cast("string")).alias("page_count"), F.lit(None).cast("string").alias("page_count_confidence"), (F.round("value") / 1024).cast("string").alias("confidence_score"),
        level.alias("readability_issues"), F.lit("").alias("readability_comment"), F.col("event_type").alias("overall_comment"),
    )
    return judgments.merge_judgments(own, ["user_id"], "event_id").drop("page_count_confidence", "readability_comment")


@query(f"""SELECT CAST(count(*) AS BIGINT) AS total_evaluations, CAST(count(*) FILTER (has_table_elements) AS BIGINT) AS has_table_elements, CAST(count(*) FILTER (has_handwritten_notes_or_marks) AS BIGINT) AS has_handwritten_notes,
    CAST(count(*) FILTER (page_count = 2) AS BIGINT) AS split_count, count(*) FILTER (page_count = 2) / count(*)::DOUBLE AS split_rate FROM ({_MERGE})""")
def spread_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = merge_judgments(spark, sf_dir).withColumn("split", F.col("page_count") == 2)
    return summaries.spread_summary(own).select("total_evaluations", "has_table_elements", "has_handwritten_notes", "split_count", "split_rate")


@query("SELECT CAST(k AS INTEGER) AS page_count, CAST(count(*) AS BIGINT) AS n FROM (SELECT least(3, greatest(1, count(*) - 64)) AS k FROM events GROUP BY user_id) GROUP BY k")
def page_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").groupBy("user_id").agg(geometry.clamp(F.count("*").cast("int") - 64, 1, 3).alias("k"))
    return summaries.histogram(own, F.col("k"), name="page_count")


_JUDGED = """(SELECT d.doc_id, l.quality, l.toxic, n_chars, CASE WHEN l.quality IS NULL THEN 'unknown' WHEN l.quality = 1 THEN 'none' WHEN l.toxic = 1 THEN 'major' ELSE 'minor' END AS lvl FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    level = F.when(F.col("quality") == 1, "none").when(F.col("toxic") == 1, "major").when(F.col("quality") == 0, "minor")
    return own.withColumns({"success": F.col("quality").isNotNull(), "readability_issues": level, "needs_dewarping": F.col("toxic") == 1, "reprocessed_at_scale": level == "major", "dewarping_applied": (F.col("toxic") == 1) & (F.col("quality") == 1)})


@query(f"SELECT lvl AS readability_issues, CAST(count(*) AS BIGINT) AS n FROM {_JUDGED} GROUP BY lvl")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.histogram(_judged(spark, sf_dir), F.col("readability_issues"), "unknown", "readability_issues")


@query(f"""SELECT CAST(count(*) AS BIGINT) AS total_pages, CAST(count(quality) AS BIGINT) AS successful_pages, CAST(count(*) FILTER (toxic = 1) AS BIGINT) AS needs_dewarping_count, CAST(count(*) FILTER (lvl = 'major') AS BIGINT) AS reprocessed_count,
    CAST(count(*) FILTER (toxic = 1 AND quality = 1) AS BIGINT) AS dewarped_count, count(quality) / count(*)::DOUBLE AS success_rate FROM {_JUDGED}""")
def quality_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.quality_summary(_judged(spark, sf_dir))


@query("SELECT CAST(count(*) AS BIGINT) AS total_pages, CAST(count(*) FILTER (quality = 1) AS BIGINT) AS successful_pages, CAST(count(*) FILTER (quality <> 1) AS BIGINT) AS failed_pages, bool_or(quality = 1) AS success FROM labels")
def success_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.render_summary(table(spark, sf_dir, "labels").withColumn("success", F.col("quality") == 1))


@query("SELECT doc_id, quality, toxic, 'kept' AS route FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, quality, toxic, 'failed' FROM labels WHERE quality <> 1")
def success_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, bad = routing.split_by_success(table(spark, sf_dir, "labels").withColumn("success", F.col("quality") == 1))
    return ok.withColumn("route", F.lit("kept")).unionByName(bad.withColumn("route", F.lit("failed"))).drop("success")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic, CASE WHEN l.toxic = 1 THEN 'rotated' WHEN l.quality = 1 THEN 'dewarped' ELSE 'original' END AS latest FROM documents d LEFT JOIN labels l USING (doc_id)")
def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = routing.look_up(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", {"quality": -1, "toxic": 0})
    latest = routing.latest_image(F.when(F.col("toxic") == 1, "rotated"), F.when(F.col("quality") == 1, "dewarped"), F.lit(None).cast("string"), F.lit("original"))
    return own.withColumn("latest", latest)


@query("SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'later' END, d.source) AS source FROM documents d LEFT JOIN labels l USING (doc_id)")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "later").alias("source"))
    return routing.carry_forward(table(spark, sf_dir, "documents").select("doc_id", "source"), later, "doc_id", ["source"])


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("path"))
    return routing.with_existing_image(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), listing, "doc_id")


@query("""SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN n_chars < 500 THEN 'too small' WHEN n_chars * 2 < 2000 THEN 'too few bytes' END AS failure FROM documents""")
def valid_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", routing.image_failure(F.col("doc_id") % 10 != 0, n, n, n * 2, 500, 2000).alias("failure"))


@query("SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 7 WHEN l.quality = 1 THEN 6 WHEN n_chars > 1000 THEN 5 WHEN n_chars > 500 THEN 2 END AS stage FROM documents d LEFT JOIN labels l USING (doc_id)")
def final_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    no = F.lit(False)
    stage = routing.final_stage(no, F.col("n_chars") > 500, no, no, F.col("n_chars") > 1000, F.col("quality") == 1, F.col("toxic") == 1)
    return own.select("doc_id", stage.alias("stage"))


@query(f"""SELECT event_id, {_K} % 2 = 0 AS needs_dewarping, CASE WHEN {_K} % 3 = 0 THEN 'Major' ELSE 'none' END AS readability_issues, {_K} % 3 = 0 AS requires_reprocessing, round({_K} / 100.0::DOUBLE, 6) AS confidence_score,
    false AS rotation_needed, {_K} % 4 AS page_count FROM events""")
def judgment_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.to_json(F.struct(F.when(k % 2 == 0, "True").otherwise("False").alias("needs_dewarping"), F.when(k % 3 == 0, "Major").alias("readability_issues"), (k / 100.0).alias("confidence_score"), (k % 4).cast("string").alias("page_count")))
    own = table(spark, sf_dir, "events").select("event_id", body.alias("p"))
    return own.select("event_id", *judgments.summary_columns(F.col("p"))).withColumn("confidence_score", F.round("confidence_score", 6))


@query(f"""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (event_id % 5 <> 0) AS BIGINT) AS successful, CAST(sum(CASE WHEN event_id % 5 <> 0 THEN {_K} ELSE 0 END) AS BIGINT) AS total_file_size_bytes,
    sum(CASE WHEN event_id % 5 <> 0 THEN 2.0::DOUBLE ELSE 0 END) / greatest(1, count(*) FILTER (event_id % 5 <> 0)) AS average_scale_factor FROM events""")
def rerender_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").select((F.col("event_id") % 5 != 0).alias("success"), F.get_json_object("props", "$.k").cast("long").alias("file_size_bytes"), F.lit(2.0).alias("scale_factor"))
    return summaries.rerender_summary(own).select("total", "successful", "total_file_size_bytes", "average_scale_factor")


@query("""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (event_id % 5 <> 0 AND event_type <> 'view') AS BIGINT) AS successful, CAST(count(*) FILTER (event_id % 5 <> 0 AND event_type = 'view') AS BIGINT) AS skipped,
    CAST(count(*) FILTER (event_id % 5 = 0) AS BIGINT) AS failed, count(*) FILTER (event_id % 5 <> 0 AND event_type <> 'view') / count(*)::DOUBLE AS success_rate, count(*) FILTER (event_id % 5 <> 0 AND event_type = 'view') / count(*)::DOUBLE AS skip_rate FROM events""")
def dewarp_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.dewarp_summary(table(spark, sf_dir, "events").select((F.col("event_id") % 5 != 0).alias("success"), (F.col("event_type") == "view").alias("skipped")))


@query(f"""SELECT CAST(count(*) AS BIGINT) AS total_images, CAST(count(*) FILTER (event_id % 5 <> 0) AS BIGINT) AS successful_images, CAST(count(*) FILTER (event_id % 5 <> 0 AND ({_BUCKET}) <> 0) AS BIGINT) AS rotated_images,
    count(*) FILTER (event_id % 5 <> 0 AND ({_BUCKET}) <> 0) / count(*)::DOUBLE AS rotation_rate FROM (SELECT event_id, {_K} * 4 - 200 AS d FROM events)""")
def rotation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.get_json_object("props", "$.k").cast("int") * 4 - 200
    return summaries.rotation_summary(table(spark, sf_dir, "events").select((F.col("event_id") % 5 != 0).alias("success"), parsing.angle_bucket(d).alias("angle")))


def _laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: session_id, path and content, the text with ? for what is not ASCII."""
    content = F.encode(F.regexp_replace("text", r"[^\x00-\x7f]", "?"), "utf-8")
    name = F.format_string("doc_%d", "doc_id")
    return table(spark, sf_dir, "documents").select(name.alias("session_id"), F.concat(name, F.lit(".pdf")).alias("path"), content.alias("content"))


_TEXT_PAGES = r"""(SELECT doc_id, t, unnest(generate_series(0, (length(t) - 1) // 10000)) AS k FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\x7f]', '?', 'g') AS t FROM documents) WHERE length(t) > 0)"""


@query(f"""SELECT 'doc_' || doc_id AS session_id, CAST(k + 1 AS INTEGER) AS page_number, CAST((length(t) + 9999) // 10000 AS INTEGER) AS total_pages, 40.0::DOUBLE AS width,
    ceil(length(substr(t, k * 10000 + 1, 10000)) / 40.0)::DOUBLE AS height FROM {_TEXT_PAGES}""")
def page_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.pages(_laid_out(spark, sf_dir), stand_ins.TextDocument).filter("success").select("session_id", "page_number", "total_pages", "width", "height")


@query(r"""SELECT 'doc_' || doc_id AS session_id, length(t) > 0 AS success, CASE WHEN length(t) > 0 THEN CAST(length(t) AS VARCHAR) ELSE '0' END AS bytes FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\x7f]', '?', 'g') AS t FROM documents)""")
def document_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scans.document_metadata(_laid_out(spark, sf_dir), stand_ins.TextDocument)
    return out.select("session_id", (F.col("metadata")["bytes"] != "0").alias("success"), F.col("metadata")["bytes"].alias("bytes"))


def _pdfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as PDF files of five kinds, by doc_id: plain, packed, updated, damaged, and no PDF; the title is the source."""
    own = _laid_out(spark, sf_dir).join(table(spark, sf_dir, "documents").select(F.format_string("doc_%d", "doc_id").alias("session_id"), (F.col("doc_id") % 5).cast("int").alias("kind"), F.col("source").alias("title")), "session_id")
    return stand_ins.as_pdfs(own)


def _in_folders(name: Column) -> Column:
    """Names in up to 256 folders, which tasks list side by side."""
    return F.concat(F.substring(F.md5(name), 1, 2), F.lit("/"), name)


_NO_PDF = r"""(SELECT doc_id FROM documents WHERE doc_id % 5 = 4 OR text = '')"""
_LINES = "ceil(length(substr(t, k * 10000 + 1, 10000)) / 40.0)"


@query(f"""SELECT 'doc_' || doc_id AS session_id, true AS success, CAST(k + 1 AS INTEGER) AS page_number, CAST((length(t) + 9999) // 10000 AS INTEGER) AS total_pages, 40.0::DOUBLE AS width, {_LINES}::DOUBLE AS height
    FROM {_TEXT_PAGES} WHERE doc_id % 5 < 4 UNION ALL SELECT 'doc_' || doc_id, false, NULL, NULL, NULL, NULL FROM {_NO_PDF}""")
def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of PDFs with their size, read from the documents' own structure; what is no PDF is a failure."""
    return scans.pages(_pdfs(spark, sf_dir), pdf.PdfDocument).select("session_id", "success", "page_number", "total_pages", "width", "height")


@query(f"""SELECT 'doc_' || doc_id AS session_id, true AS valid, NULL AS failure, CAST((length(t) + 9999) // 10000 AS INTEGER) AS total_pages, CAST(least(600, greatest(50, least(2048 * 72.0::DOUBLE / 40, 2560 * 72.0::DOUBLE / {_LINES}))) AS INTEGER) AS suggested_dpi,
    source AS title, 'PDF 1.7' AS format FROM {_TEXT_PAGES} JOIN documents USING (doc_id) WHERE k = 0 AND doc_id % 5 < 4
    UNION ALL SELECT 'doc_' || doc_id, false, 'unreadable', NULL, NULL, CASE WHEN doc_id % 5 < 4 THEN source END, CASE WHEN doc_id % 5 < 4 THEN 'PDF 1.7' END FROM {_NO_PDF} JOIN documents USING (doc_id)""")
def pdf_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity, pages, suggested resolution and entries of PDFs."""
    docs = _pdfs(spark, sf_dir)
    info = scans.document_info(docs, pdf.PdfDocument).select("session_id", "valid", "failure", "total_pages", F.when(F.col("valid"), F.col("suggested_dpi")).alias("suggested_dpi"))
    entries = scans.document_metadata(docs, pdf.PdfDocument).select("session_id", F.col("metadata")["title"].alias("title"), F.col("metadata")["format"].alias("format"))
    return info.join(entries, "session_id")


@query(f"""SELECT 'doc_' || doc_id || '.pdf' AS file, CAST(k + 1 AS INTEGER) AS page_number, 40 AS width, CAST({_LINES} AS INTEGER) AS height, md5(CASE WHEN doc_id % 5 = 1 THEN reverse(p) ELSE p END) AS image_md5
    FROM (SELECT *, rpad(substr(t, k * 10000 + 1, 10000), CAST(40 * {_LINES} AS INTEGER), ' ') AS p FROM {_TEXT_PAGES}) WHERE doc_id % 5 < 4""")
def pdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDFs written as files that are committed together, listed, and rendered by ranges of pages from where they are."""
    folder = committed.shared_folder(spark, "pdf-files")
    committed.write_named(_pdfs(spark, sf_dir).select(_in_folders(F.col("path")).alias("name"), "content"), folder)
    sized = scans.pages(scans.documents(spark, folder), pdf.PdfDocument).filter("success").withColumn("dpi", F.lit(72))
    drawn = scans.render_files(sized, pdf.PdfDocument, size=4)
    return drawn.select(names.basename(F.col("path")).alias("file"), "page_number", "width", "height", F.md5("image").alias("image_md5"))


@query("""SELECT conv_id, CAST(CASE WHEN count(*) FILTER (role = 'user') = count(*) FILTER (role = 'assistant') THEN count(*) FILTER (role = 'user') ELSE 0 END AS INTEGER) AS pairs FROM conversations GROUP BY conv_id""")
def paired_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda r: F.collect_list(F.when(F.col("role") == r, F.col("turn")))
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(of("user").alias("u"), of("assistant").alias("a"))
    return own.select("conv_id", F.size(routing.pair_arrays(F.col("u"), F.col("a"))).alias("pairs"))


# -- kernels, recognizers and sinks: no SQL -----------------------------------
def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grey images 16 wide and at least 24 high made of each whole text's bytes, padded at the end; pixel values are the text's."""
    height = F.greatest(F.lit(24), F.ceil(F.length("text") / 16)).cast("int")
    data = F.to_binary(F.rpad(F.regexp_replace("text", r"[^\x00-\x7f]", "?"), height * 16, " "), F.lit("utf-8"))
    image = F.struct(F.col("source").alias("origin"), height.alias("height"), F.lit(16).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), data.alias("data"))
    return table(spark, sf_dir, "documents").select("doc_id", (F.element_at(F.array(*map(F.lit, [0, 90, -90, 180])), (F.col("doc_id") % 4 + 1).cast("int"))).alias("angle"), image.alias("image"))


#: The images of _images in SQL: doc_id, h, t (16 characters a row).
_PIXELS = r"""(SELECT doc_id, h, rpad(substr(t, 1, h * 16), h * 16, ' ') AS t FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\x7f]', '?', 'g') AS t, greatest(24, CAST(ceil(length(text) / 16.0) AS INTEGER)) AS h FROM documents))"""


@query(f"""SELECT doc_id, CAST(i AS INTEGER) AS strip, md5(substr(t, 1 + i * 64, 64)) AS strip_md5 FROM (SELECT doc_id, t, unnest(generate_series(0, (h + 3) // 4 - 1)) AS i FROM {_PIXELS})""")
def image_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.floor((F.col("image.height") + 3) / 4).cast("int") - 1
    own = _images(spark, sf_dir).select("doc_id", "image", F.explode(F.sequence(F.lit(0), last)).alias("strip"))
    cut = images.slice_rows(F.col("image"), F.col("strip") * 4, F.least(F.col("strip") * 4 + 4, F.col("image.height")))
    return own.select("doc_id", "strip", F.md5(cut["data"]).alias("strip_md5"))


# a quarter turn permutes bytes: its rows are the columns of the image, read from the other end
@query(f"""WITH p AS (SELECT doc_id, h, t, [0, 90, -90, 180][CAST(doc_id % 4 + 1 AS INTEGER)] AS angle FROM {_PIXELS}),
    c AS (SELECT doc_id, k, string_agg(substr(t, 1 + r * 16 + k, 1), '' ORDER BY r) AS col FROM (SELECT doc_id, t, r, unnest(generate_series(0, 15)) AS k FROM (SELECT doc_id, t, unnest(generate_series(0, h - 1)) AS r FROM p WHERE abs(angle) = 90)) GROUP BY doc_id, k),
    q AS (SELECT doc_id, string_agg(reverse(col), '' ORDER BY k) AS right_, string_agg(col, '' ORDER BY 15 - k) AS left_ FROM c GROUP BY doc_id)
    SELECT doc_id, angle, CASE WHEN abs(angle) = 90 THEN 16 ELSE h END AS height, CASE WHEN abs(angle) = 90 THEN h ELSE 16 END AS width,
    md5(CASE angle WHEN 0 THEN t WHEN 180 THEN reverse(t) WHEN 90 THEN right_ ELSE left_ END) AS image_md5, CAST(NULL AS VARCHAR) AS error FROM p LEFT JOIN q USING (doc_id)""")
def image_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = images.rotate_images(_images(spark, sf_dir))
    return out.select("doc_id", "angle", "image.height", "image.width", F.md5("image.data").alias("image_md5"), "error")


@query(f"""SELECT doc_id, h AS height, 16 AS width, true AS close FROM {_PIXELS}""")
def image_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images encoded as JPEG files that are committed together, decoded by Spark's image source, and held against the originals: close is a mean of at most 3 of 255."""
    folder, own = committed.shared_folder(spark, "image-jpeg"), _images(spark, sf_dir)
    outputs.write_files(outputs.image_files(own, _in_folders(F.format_string("doc_%d.jpg", "doc_id")), outputs.jpeg), folder)
    number = F.regexp_extract("path", r"doc_(\d+)\.jpg$", 1).cast("long").alias("doc_id")
    read = scans.decoded_images(spark, folder, committed.shared_folder(spark, "image-jpeg-decoded")).filter("success").select(number, F.col("image").alias("decoded"))
    apart = images.differences(own.join(read, "doc_id").withColumns({"height": F.col("decoded.height"), "width": F.col("decoded.width")}), "image", "decoded", ["doc_id", "height", "width"])
    return apart.select("doc_id", "height", "width", F.coalesce(F.col("mean") <= 3, F.lit(False)).alias("close"))


# a shift by whole pixels moves the middle of a row along
@query(f"""WITH p AS (SELECT doc_id, h, t, ascii(t) % 5 - 2 AS dx, ascii(substr(t, 2, 1)) % 5 - 2 AS dy FROM {_PIXELS}),
    r AS (SELECT doc_id, k, substr(t, CAST(1 + (k + dy) * 16 + 2 + dx AS BIGINT), 12) AS line FROM (SELECT *, unnest(generate_series(2, h - 3)) AS k FROM p))
    SELECT doc_id, CAST(count(*) AS INTEGER) AS height, 12 AS width, md5(string_agg(line, '' ORDER BY k)) AS image_md5, CAST(NULL AS VARCHAR) AS error FROM r GROUP BY doc_id""")
def image_dewarp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images straightened to corners that lie whole pixels beside their own, cut by the margin that may come from outside."""
    out = images.dewarp_images(_images(spark, sf_dir), stand_ins.Shifted, cfg=Dewarp(enable_strong_correction=False, crop_margin_px=2))
    return out.select("doc_id", "image.height", "image.width", F.md5("image.data").alias("image_md5"), "error")


def _no_sleep(_: float) -> None:
    return None


@query(r"""WITH g AS (SELECT conv_id, turn % 2 AS m, string_agg(text, chr(10) ORDER BY (role <> 'system')::INT, turn) AS llm, string_agg(CASE WHEN t <> '' THEN t END, chr(10) || chr(10) ORDER BY (role <> 'system')::INT, turn) AS dai
      FROM (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations) GROUP BY conv_id, turn % 2),
    p AS (SELECT conv_id, m, 'llm' AS engine, regexp_replace(llm, '^\s+|\s+$', '', 'g') AS t FROM g UNION ALL SELECT conv_id, m, 'document_ai', dai FROM g)
    SELECT CAST(conv_id AS VARCHAR) AS session_id, engine, CAST(count(*) AS BIGINT) AS files_count, md5(string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY m)) AS text_md5, CAST(length(string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY m)) AS INTEGER) AS total_characters
    FROM p WHERE t <> '' GROUP BY conv_id, engine""")
def stub_ocr_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _tiles_of_conversations(spark, sf_dir).withColumns({"session_id": F.col("page_number").cast("string"), "group_key": names.group_key(F.col("page_number"), F.col("source_mask_index"))})
    keys = ["session_id", "page_number", "source_mask_index", "group_key"]
    engines = stages.Engines(recognition.StubRecognizer, recognition.StubImageRecognizer, _no_sleep)
    out = stages.integrate_results(stages.recognize(own, keys, engines, image="text"))
    return out.select("session_id", "engine", "files_count", F.md5("integrated_text").alias("text_md5"), "total_characters")


@query("""SELECT conv_id, turn, CAST(NULL AS VARCHAR) AS warning, text AS extracted_text, 'True' AS flag FROM conversations""")
def result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit(True).alias("success"), F.col("text").alias("extracted_text"), F.lit("g").alias("group_key"), F.lit(1).alias("processed_images"), F.lit("ok").alias("note"), F.col("text").alias("response"))
    body = own.withColumn("j", outputs.result_json(Ocr(), {"flag": coerce.as_flag_text(F.col("success"))}))
    return body.select("conv_id", "turn", F.get_json_object("j", "$.warnings[0]").alias("warning"), F.get_json_object("j", "$.ocr_result.extracted_text").alias("extracted_text"), F.get_json_object("j", "$.flag").alias("flag"))


# pages turned by 180 degrees or cut into halves of 22 dots, then strips of each height, all digests of bytes
_WHOLE = rf"""WITH o AS (SELECT doc_id, k, ascii(raw) AS dot, CAST(ceil(length(raw) / 40.0) AS BIGINT) AS h, rpad(raw, CAST(ceil(length(raw) / 40.0) * 40 AS INTEGER), ' ') AS t
      FROM (SELECT doc_id, k, substr(t, k * 10000 + 1, 10000) AS raw FROM {_TEXT_PAGES})),
    f AS (SELECT doc_id, k, dot, CASE WHEN dot % 7 = 0 THEN h + 1 ELSE h END AS h, CASE WHEN dot % 7 = 0 THEN t || repeat('#', 40) ELSE t END AS t FROM o),
    p AS (SELECT doc_id, k, h, CASE WHEN dot % 5 = 0 AND h > 1 THEN reverse(t) ELSE t END AS t FROM f),
    r AS (SELECT doc_id, k, h, CASE WHEN ascii(t) % 4 = 1 THEN reverse(t) ELSE t END AS t FROM p),
    d AS (SELECT *, ascii(t) % 2 = 0 AS spread FROM r),
    s AS (SELECT doc_id, k, h, m, string_agg(substr(t, 1 + i * 40 + CASE WHEN m = 1 THEN 18 ELSE 0 END, w), '' ORDER BY i) AS t, w FROM
      (SELECT doc_id, k, h, t, m, CASE WHEN spread THEN 22 ELSE 40 END AS w, unnest(generate_series(0, h - 1)) AS i FROM (SELECT *, unnest(generate_series(0, CASE WHEN spread THEN 1 ELSE 0 END)) AS m FROM d)) GROUP BY doc_id, k, h, m, w),
    b AS (SELECT *, h // n AS base, CAST(floor((h // n) * 0.1::DOUBLE) AS BIGINT) AS lap FROM (SELECT *, greatest(1, h // 100) AS n FROM s)),
    x AS (SELECT doc_id, k, m, i, CASE WHEN i < 0 THEN md5(t) ELSE md5(substr(t, 1 + w * greatest(0, i * base - lap), w * (CASE WHEN i = n - 1 THEN h ELSE least(h, (i + 1) * base + lap) END - greatest(0, i * base - lap)))) END AS f
      FROM (SELECT *, unnest(generate_series(-1, n - 1)) AS i FROM b)),
    g AS (SELECT doc_id, k, m, 'llm' AS engine, string_agg(f, chr(10) ORDER BY i) AS t FROM x GROUP BY doc_id, k, m UNION ALL SELECT doc_id, k, m, 'document_ai', string_agg(f, chr(10) || chr(10) ORDER BY i) FROM x GROUP BY doc_id, k, m)"""


@query(f"""{_WHOLE} SELECT 'doc_' || doc_id AS session_id, engine, CAST(count(*) AS BIGINT) AS files_count, md5(string_agg(t, chr(10) || chr(10) || chr(10) ORDER BY k, m)) AS text_md5, CAST(sum(length(t)) + 3 * (count(*) - 1) AS INTEGER) AS total_characters FROM g GROUP BY doc_id, engine""")
def whole_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven stages over synthetic pages: rendered, judged, some rendered again or straightened, turned, cut, tiled, recognised by two engines, integrated."""
    parts = whole.Components(
        stand_ins.FinerDocument,
        distortion=stand_ins.FirstDot,
        orientation=stand_ins.FirstDot,
        page_count=stand_ins.FirstDot,
        detector=stand_ins.UpsideDown,
        llm=stand_ins.FingerprintRecognizer,
        document_ai=stand_ins.FingerprintImageRecognizer,
        sleep=_no_sleep,
    )
    settings = overlay(Settings(), {"steps": {"judge": True, "rotate": True}, "dewarp": {"enable_strong_correction": False}})
    got = whole.run(_laid_out(spark, sf_dir), parts, settings, last=True)
    return got.tables["integrate"].select("session_id", "engine", "files_count", F.md5("integrated_text").alias("text_md5"), "total_characters")


@query(f"""SELECT user_id, count(*) AS images, bool_or({_K} % 5 = 1) AS has_table_elements, CAST(least(3, greatest(1, sum({_K} % 3))) AS INTEGER) AS page_count, round_even(avg(({_K} % 16) / 16.0::DOUBLE), 3) AS confidence_score FROM events GROUP BY user_id""")
def merge_typed_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments whose JSON holds numbers: flags as 0 and 1, counts as 2.7, confidences that tie in the third decimal."""
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.to_json(F.struct((k % 5 == 1).cast("int").alias("has_table_elements"), ((k % 3) + F.lit(0.7)).alias("page_count"), ((k % 16) / F.lit(16.0)).alias("confidence_score")))
    own = table(spark, sf_dir, "events").select("user_id", "event_id", F.lit(True).alias("success"), *judgments.page_count_columns(body))
    return judgments.merge_judgments(own, ["user_id"], "event_id").select("user_id", "images", "has_table_elements", "page_count", "confidence_score")


# 2^70 times a double of at least 2^-17 is whole, so the side of the tie that it lies on is decided without error
@query("""SELECT event_id, CASE WHEN k % 2 = 0 THEN k / 2 WHEN k < 1 THEN 0 WHEN m * 2000 > k * one OR m * 2000 = k * one AND k % 4 = 3 THEN k // 2 + 1 ELSE k // 2 END / 1000.0::DOUBLE AS confidence_score
    FROM (SELECT event_id, CAST(event_id % 2001 AS HUGEINT) AS k, CAST((event_id % 2001) / 2000.0::DOUBLE * 1180591620717411303424.0::DOUBLE AS HUGEINT) AS m, 1180591620717411303424::HUGEINT AS one FROM events)""")
def exact_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidences of k / 2000, every second of which is nearly between two decimals, rounded by their exact value."""
    body = F.to_json(F.struct(((F.col("event_id") % 2001) / F.lit(2000.0)).alias("confidence_score")))
    own = table(spark, sf_dir, "events").select("event_id", F.lit(0).alias("image_idx"), F.lit(True).alias("success"), *judgments.page_count_columns(body))
    return judgments.merge_judgments(own, ["event_id"], "image_idx").select("event_id", "confidence_score")


@query("""SELECT doc_id, CAST(row_number() OVER (ORDER BY coalesce(CASE WHEN doc_id % 7 > 0 THEN doc_id % 97 END, 0), doc_id) AS BIGINT) AS place FROM documents""")
def page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 97).alias("page_number"))
    return summaries.in_page_order(own, "page_number", "doc_id").select("doc_id", "place")


@query("""SELECT conv_id AS session_id, CAST(count(*) AS INTEGER) AS file_count, md5(string_agg(f, ',' ORDER BY f)) AS files_md5 FROM (SELECT conv_id, role || '_' || turn || '.txt' AS f FROM conversations) GROUP BY conv_id""")
def file_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("session_id"), F.array(F.concat_ws("_", "role", F.concat("turn", F.lit(".txt")))).alias("files"))
    return outputs.file_lists(own).select("session_id", "file_count", F.md5(F.array_join("files", ",")).alias("files_md5"))


@query("""SELECT CAST(count(DISTINCT conv_id) AS BIGINT) AS total_groups, CAST(count(*) FILTER (role = 'user' AND turn % 5 <> 4) AS BIGINT) AS llm_groups_processed, CAST(count(*) FILTER (role = 'user' AND turn % 5 = 4) AS BIGINT) AS llm_groups_failed,
    CAST(2 * count(*) FILTER (role = 'user' AND turn % 5 <> 4) AS BIGINT) AS llm_files_created, coalesce(avg(length(text)) FILTER (role = 'user' AND turn % 5 <> 4), 0) AS llm_average_text_length,
    CAST(count(*) FILTER (role = 'assistant' AND turn % 5 <> 4) AS BIGINT) AS document_ai_groups_processed, CAST(count(*) FILTER (role = 'assistant' AND turn % 5 = 4) AS BIGINT) AS document_ai_groups_failed,
    CAST(2 * count(*) FILTER (role = 'assistant' AND turn % 5 <> 4) AS BIGINT) AS document_ai_files_created, coalesce(avg(length(text)) FILTER (role = 'assistant' AND turn % 5 <> 4), 0) AS document_ai_average_text_length,
    CAST(2 * count(*) FILTER (role IN ('user', 'assistant') AND turn % 5 <> 4) AS BIGINT) AS total_files_created FROM conversations""")
def recognition_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = F.when(F.col("role") == "user", "llm").when(F.col("role") == "assistant", "document_ai")
    own = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("group_key"), engine.alias("engine"), (F.col("turn") % 5 != 4).alias("success"), F.col("text").alias("extracted_text"), F.lit(2).alias("files"))
    return summaries.recognition_statistics(own)


@query("""SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (doc_id % 9 <> 0) AS BIGINT) AS successful, CAST(count(*) FILTER (doc_id % 9 = 0) AS BIGINT) AS failed, CAST(coalesce(sum(n_chars) FILTER (doc_id % 9 <> 0), 0) AS BIGINT) AS total_file_size_bytes,
    round(avg(50 + doc_id % 551) FILTER (doc_id % 9 <> 0), 6) AS average_dpi, count(*) FILTER (doc_id % 9 <> 0) / count(*)::DOUBLE AS success_rate FROM documents""")
def render_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select((F.col("doc_id") % 9 != 0).alias("success"), (50 + F.col("doc_id") % 551).alias("used_dpi"), F.col("n_chars").alias("file_size_bytes"))
    return summaries.render_totals(own).withColumn("average_dpi", F.round("average_dpi", 6))


@query(r"""SELECT engine, printf('conv_%d_page_%03d_mask1', conv_id, turn) || CASE WHEN engine = 'llm' THEN '_ocr_result.txt' ELSE '_documentai_result.txt' END AS filename, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS content_length
    FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN 'llm' ELSE 'document_ai' END AS engine, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations) WHERE t <> ''""")
def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of both engines written as named files that are committed together, and read again as saved texts."""
    folder = committed.shared_folder(spark, "text-files")
    key = F.format_string("conv_%d_page_%03d_mask1", "conv_id", "turn")
    own = table(spark, sf_dir, "conversations").select((F.col("turn") % 2).alias("side"), F.col("conv_id").cast("string").alias("session_id"), key.alias("group_key"), F.lit(True).alias("success"), F.col("text").alias("extracted_text"))
    for side, engine in enumerate(("llm", "document_ai")):
        failed = outputs.write_result_files(own.filter(F.col("side") == side), folder, engine, F.lit(None), Ocr(output_format="txt"))
        if failed["txt"]:
            raise OSError(failed["txt"])
    return texts.text_parts(spark, folder).select("engine", "filename", F.md5("text").alias("text_md5"), "content_length")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
