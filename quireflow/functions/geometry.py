"""Resolutions, strips and spreads as Column expressions; every one stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quireflow.config import Render, Tiling

POINTS_PER_INCH = 72.0
#: Square inches of a letter page, by which the pixel bound turns into a resolution.
PAGE_AREA = 8.5


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def optimal_dpi(width: Column, height: Column, cfg: Render = Render()) -> Column:
    """Resolution that fits the page into the target size; the default for a page without area."""
    fit = F.least(F.lit(cfg.target_width * POINTS_PER_INCH) / width, F.lit(cfg.target_height * POINTS_PER_INCH) / height)
    bounded = clamp(fit, float(cfg.min_dpi), float(cfg.max_dpi)).cast("int")
    return F.when((width > 0) & (height > 0), bounded).otherwise(F.lit(cfg.default_dpi))


def output_size(width: Column, height: Column, dpi: Column) -> Column:
    side = lambda c: (c * dpi / F.lit(POINTS_PER_INCH)).cast("int")
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def zoom_factor(dpi: Column) -> Column:
    return dpi / F.lit(POINTS_PER_INCH)


def scaled_dpi(dpi: Column, factor: float | None = None, cfg: Render = Render()) -> Column:
    """Resolution of a second rendering; an unknown one counts as the default."""
    wanted = (F.coalesce(dpi, F.lit(cfg.default_dpi)) * F.lit(float(factor or cfg.rescale_factor))).cast("int")
    return clamp(wanted, cfg.min_dpi, cfg.max_dpi)


def memory_capped_dpi(dpi: Column, cfg: Render = Render()) -> Column:
    """Lower a resolution whose page would exceed the pixel bound."""
    cap = clamp(F.floor(F.sqrt(F.lit(cfg.max_pixels / PAGE_AREA))).cast("int"), cfg.min_dpi, cfg.max_dpi)
    return F.when(dpi * dpi * F.lit(PAGE_AREA) > F.lit(float(cfg.max_pixels)), cap).otherwise(dpi)


def dpi_levels(width: Column, height: Column, cfg: Render = Render()) -> Column:
    """Array of level, dpi, width, height, zoom for the four levels of a report."""
    levels = {"min": F.lit(cfg.min_dpi), "optimal": optimal_dpi(width, height, cfg), "default": F.lit(cfg.default_dpi), "max": F.lit(cfg.max_dpi)}
    rows = []
    for level, dpi in levels.items():
        size = output_size(width, height, dpi)
        rows.append(F.struct(F.lit(level).alias("level"), dpi.alias("dpi"), size["width"].alias("width"), size["height"].alias("height"), zoom_factor(dpi).alias("zoom")))
    return F.array(*rows)


def dpi_verdict(dpi: Column, cfg: Render = Render()) -> Column:
    """valid and the nearest allowed resolution."""
    return F.struct(F.coalesce(dpi.between(cfg.min_dpi, cfg.max_dpi), F.lit(False)).alias("valid"), clamp(F.coalesce(dpi, F.lit(cfg.default_dpi)), cfg.min_dpi, cfg.max_dpi).alias("suggested"))


def strip_regions(height: Column, cfg: Tiling = Tiling()) -> Column:
    """Array of (start, end) of overlapping strips; fewer strips where they would be too low."""
    h = height.cast("int")
    n0 = F.lit(cfg.num_splits)
    low = F.floor(h / n0) < F.lit(cfg.min_height_per_split)
    n = F.when(low, F.greatest(F.lit(1), F.floor(h / F.lit(cfg.min_height_per_split)).cast("int"))).otherwise(n0)
    base = F.floor(h / n).cast("int")
    overlap = F.floor(base * F.lit(float(cfg.overlap_ratio))).cast("int")

    def region(i: Column) -> Column:
        end = F.when(i == n - 1, h).otherwise(F.least(h, (i + 1) * base + overlap))
        return F.struct(F.greatest(F.lit(0), i * base - overlap).cast("int").alias("start"), end.cast("int").alias("end"))

    return F.transform(F.sequence(F.lit(0), n - 1), region)


def spread_regions(width: Column, overlap_ratio: float = 0.1) -> Column:
    """Array of side, start, end of the two overlapping halves of a spread."""
    w = width.cast("int")
    half = F.floor(w / 2).cast("int")
    lap = F.floor(F.floor(w * F.lit(float(overlap_ratio))) / 2).cast("int")
    left = F.struct(F.lit("left").alias("side"), F.lit(0).alias("start"), (half + lap).alias("end"))
    right = F.struct(F.lit("right").alias("side"), (half - lap).alias("start"), w.alias("end"))
    return F.array(left, right)


def contour_slope(start_y: Column, end_y: Column, ratio: Column, points: int = 12) -> Column:
    """Vertical shift of a page edge at a horizontal ratio: 0 at grid points, else the edge's height left of it."""
    at = ratio * F.lit(float(points - 1))
    low, high = F.floor(at), F.ceil(at)
    y = lambda k: (start_y + (end_y - start_y) * k / F.lit(float(points - 1))) * (F.lit(1.0) - ratio)
    return F.when(low == high, 0.0).otherwise(y(low) * (high - at) + y(high) * (at - low))
