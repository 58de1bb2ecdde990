"""The stages composed: judged pages to tiles, groups, recognised text and integrated text.

A stage that is switched off passes its rows on.  Nothing is collected between
stages; only the merge by page, the groups and the integration shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.config import Settings
from quireflow.functions.geometry import spread_regions
from quireflow.functions.parsing import parse_ocr
from quireflow.operators import integration, recognition, routing, tiles


@dataclass(frozen=True)
class Engines:
    """Factories of the two recognizers."""

    llm: Callable[[], recognition.Recognizer] = recognition.StubRecognizer
    document_ai: Callable[[], recognition.ImageRecognizer] = recognition.StubImageRecognizer
    sleep: Callable[[float], None] = time.sleep


def split_spreads(pages: DataFrame, width: str, settings: Settings = Settings()) -> DataFrame:
    """Rows of pages, spreads as two with start_x, end_x and source_mask_index 0 and 1."""
    w = F.col(width).cast("int")
    whole = F.array(F.struct(F.lit("whole").alias("side"), F.lit(0).alias("start"), w.alias("end")))
    skip = F.col("skip_processing") if "skip_processing" in pages.columns else F.lit(False)
    images = F.col("processed_images") if "processed_images" in pages.columns else F.array(F.lit(""))
    cut = F.lit(settings.steps.split) & routing.should_split(F.col("page_count"), skip, images)
    parts = F.when(cut, spread_regions(w, settings.tiling.overlap_ratio)).otherwise(whole)
    out = pages.select("*", F.posexplode(parts).alias("source_mask_index", "part"))
    return out.select(*pages.columns, "source_mask_index", F.col("part.side").alias("side"), F.col("part.start").alias("start_x"), F.col("part.end").alias("end_x"))


def recognize(tile_rows: DataFrame, keys: list[str], engines: Engines, settings: Settings = Settings(), image: str = "image_path", store: str | None = None) -> DataFrame:
    """engine, success, extracted_text, note of both engines, long form.

    Calls are paid for: where ``store`` names a folder, the answers are written
    there and read back, so that no use of the result calls again.
    """
    keep = lambda df, name: recognition.write_once(df, f"{store}/{name}") if store else df
    groups = tiles.ocr_groups(tile_rows, image, tuple(k for k in keys if k not in ("page_number", "source_mask_index", "group_key")))
    answers = keep(recognition.recognize_groups(groups, engines.llm, keys, cfg=settings.ocr, sleep=engines.sleep), "llm")
    parsed = parse_ocr(answers.withColumn("response", F.coalesce("response", F.lit("")))).select(*keys, "engine", "success", F.when(F.col("success"), F.col("extracted_text")).alias("extracted_text"), F.when(F.col("success"), F.col("note")).alias("note"), "processed_images", F.lit(None).cast("double").alias("average_confidence"))
    own = tile_rows.withColumn("group_key", tiles.group_key(F.col("page_number"), F.col("source_mask_index")))
    read = keep(recognition.document_ai_results(own, engines.document_ai, image, keys, settings.ocr, engines.sleep), "document_ai")
    read = read.select(*keys, "engine", "success", F.when(F.col("success"), F.col("combined_text")).alias("extracted_text"), F.lit(None).cast("string").alias("note"), F.col("processed_images").cast("int").alias("processed_images"), "average_confidence")
    return parsed.unionByName(read)


def integrate_results(results: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """session_id, engine and the text of all groups in order of page and mask; ``compat`` orders by the key's text."""
    order = [F.col("group_key")] if settings.compat else [F.col("page_number"), F.col("source_mask_index")]
    return integration.integrate(routing.succeeded(results), ["session_id", "engine"], order, "extracted_text", settings.integration)


def process_pages(pages: DataFrame, engines: Engines = Engines(), settings: Settings = Settings(), image: str = "image_path", store: str | None = None) -> DataFrame:
    """From page rows (session_id, page_number, page_count, width, height, image_path) to integrated text."""
    keys = ["session_id", "page_number", "source_mask_index", "group_key"]
    sources = split_spreads(pages, "width", settings)
    tile_rows = tiles.tile_records(sources, F.col("height"), settings.tiling)
    return integrate_results(recognize(tile_rows, keys, engines, settings, image, store), settings)
