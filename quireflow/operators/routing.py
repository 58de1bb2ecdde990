"""Which rows go where: predicates, lookups with defaults, first-failing reasons, choices between stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.functions.coerce import strip, to_bool


def succeeded(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce("success", F.lit(False)))


def split_by_success(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that succeeded and the rest; a null counts as failed."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def with_existing_image(df: DataFrame, listing: DataFrame, path: str = "image_path") -> DataFrame:
    """Rows whose image is among the listed files."""
    return df.join(listing.select(F.col("path").alias(path)).distinct(), path, "left_semi")


def needs_rerender(success: Column, readability: Column) -> Column:
    return F.coalesce(success & (F.lower(readability) == "major"), F.lit(False))


def needs_dewarp(success: Column, flag: Column, compat: bool = False) -> Column:
    """A judged page whose flag is true; ``compat`` takes any non-empty flag text for true."""
    on = F.coalesce(flag, F.lit("")) != "" if compat else to_bool(flag)
    return F.coalesce(success, F.lit(False)) & on


def should_split(page_count: Column, skip: Column, images: Column) -> Column:
    """A spread: two pages on the only image of a record that is not to be skipped."""
    return F.coalesce((page_count == 2) & ~F.coalesce(skip, F.lit(False)) & (F.size(images) == 1), F.lit(False))


def images_of(images: Column, single: Column) -> Column:
    """Non-null images, else the single one."""
    own = F.filter(F.coalesce(images, F.array().cast("array<string>")), lambda x: x.isNotNull())
    return F.when(F.size(own) > 0, own).otherwise(F.filter(F.array(single), lambda x: x.isNotNull()))


def has_text(text: Column) -> Column:
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))


def first_failure(*checks: tuple[Column, str]) -> Column:
    """The reason of the first check that holds, null where none does."""
    out = F.lit(None).cast("string")
    for failed, reason in reversed(checks):
        out = F.when(F.coalesce(failed, F.lit(True)), reason).otherwise(out)
    return out


def image_failure(exists: Column, width: Column, height: Column, size: Column, least_side: int = 100, least_bytes: int = 1000) -> Column:
    """Why an output image is not valid."""
    return first_failure((~exists, "missing"), ((width < least_side) | (height < least_side), "too small"), (size < least_bytes, "too few bytes"))


def document_failure(pages: Column, first_page_loads: Column) -> Column:
    return first_failure((pages.isNull(), "unreadable"), (pages <= 0, "no pages"), (~first_page_loads, "first page does not load"))


def latest_image(rotated: Column, dewarped: Column, rerendered: Column, original: Column) -> Column:
    return F.coalesce(rotated, dewarped, rerendered, original)


def final_stage(*success_by_stage: Column) -> Column:
    """Number of the last stage that succeeded (stages in order, counted from 1), null if none did."""
    return F.coalesce(*(F.when(ok, k) for k, ok in reversed(list(enumerate(success_by_stage, 1)))))


def look_up(pages: DataFrame, info: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left lookup by key with defaults for what is missing."""
    out = pages.join(info, key, "left")
    return out.select(*[F.coalesce(c, F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in out.columns])


def carry_forward(pages: DataFrame, update: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of an earlier stage with the columns of a later one where it has the key."""
    later = update.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    out = pages.join(later, key, "left")
    return out.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in pages.columns])


def pair_arrays(left: Column, right: Column) -> Column:
    """Two arrays zipped; an empty array where their lengths differ."""
    both = F.arrays_zip(left.alias("left"), right.alias("right"))
    return F.when(F.size(left) == F.size(right), both).otherwise(F.slice(both, 1, 0))


def compare_engines(results: DataFrame, first: str, second: str, value: str = "extracted_text") -> DataFrame:
    """One row per group with the values of two engines, null where an engine has none."""
    side = lambda e, name: results.filter(F.col("engine") == e).select("group_key", F.col(value).alias(name))
    return side(first, first).join(side(second, second), "group_key", "full_outer")
