"""Strips of pages and the groups that go to recognition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.config import Tiling
from quireflow.functions.geometry import strip_regions
from quireflow.functions.names import group_key


def tile_records(sources: DataFrame, height: Column, cfg: Tiling = Tiling()) -> DataFrame:
    """Rows of a source image's strips (numbered from 1) and, where it is kept, of the original (number 0).

    sources keeps its columns; added are image_type, split_index, split_total, start_y, end_y.
    """
    regions = strip_regions(height, cfg)
    total = F.size(regions)
    row = lambda kind, k, lo, hi: F.struct(F.lit(kind).alias("image_type"), k.cast("int").alias("split_index"), total.alias("split_total"), lo.alias("start_y"), hi.alias("end_y"))
    splits = F.transform(regions, lambda r, i: row("split", i + 1, r["start"], r["end"]))
    tiles = F.concat(splits, F.array(row("original", F.lit(0), F.lit(0), height.cast("int")))) if cfg.save_original else splits
    return sources.select("*", F.inline(tiles))


def page_tiles(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Per page: strips, sources and all its tiles in order."""
    tile = F.struct("source_mask_index", (F.col("image_type") == "original").alias("last"), "split_index", "image_type")
    return tiles.groupBy(*keys).agg(
        F.count_if(F.col("image_type") == "split").alias("split_count"),
        F.count_distinct("source_mask_index").alias("source_count"),
        F.transform(F.array_sort(F.collect_list(tile)), lambda x: F.struct(x["source_mask_index"], x["image_type"], x["split_index"])).alias("tiles"),
    )


def ocr_groups(tiles: DataFrame, image: str = "image_path", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per (page, mask): key and images, the original first, then strips by number."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct((F.col("image_type") != "original").alias("later"), "split_index", F.col(image).alias("image"), "image_type"))), lambda x: F.struct(x["image"].alias("image"), x["image_type"].alias("image_type"), x["split_index"].alias("split_index")))
    out = tiles.groupBy(*keys, "page_number", "source_mask_index").agg(ordered.alias("images"))
    return out.withColumn("group_key", group_key(F.col("page_number"), F.col("source_mask_index")))


def tiles_of_type(tiles: DataFrame, kind: str = "all", image: str = "image_path") -> DataFrame:
    """Paths of tiles of a type (split, original, all) in order."""
    return (tiles if kind == "all" else tiles.filter(F.col("image_type") == kind)).select(image).orderBy(image)


def tiling_summary(tiles: DataFrame, page: str = "page_number") -> DataFrame:
    """Pages, strips, sources and mean strips per page, one row; 0 with no pages.

    Counts by page first, so nothing but one row per page reaches the total.
    """
    pages = tiles.groupBy(page).agg(F.count_if(F.col("image_type") == "split").alias("n"), F.count_distinct("source_mask_index").alias("s"))
    total = pages.agg(F.count("*").alias("total_pages"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_split_images"), F.coalesce(F.sum("s"), F.lit(0)).alias("total_source_images"))
    return total.withColumn("average_splits_per_page", F.coalesce(F.try_divide(F.col("total_split_images").cast("double"), F.col("total_pages").cast("double")), F.lit(0.0)))
