"""Names of files, groups and sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Media types by suffix (fixed values); jpeg is the default.
MEDIA_TYPES = {".png": "image/png", ".pdf": "application/pdf"}


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The last part of a path without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(basename(path), r".(\.[^.]*)$", 1))


def page_image_name(path: Column, page: Column, end: str = ".jpg") -> Column:
    return F.format_string(f"%s_page_%03d{end}", stem(path), page)


def group_key(page: Column, mask_index: Column) -> Column:
    """Key of a recognition group; masks count from 1 in names."""
    return F.format_string("page_%03d_mask%d", page, mask_index + 1)


def with_suffix(path: Column, add: str = "_rot", end: str = ".jpg") -> Column:
    """The path with something added to its stem; only the last part changes."""
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return F.concat(folder, stem(path), F.lit(add + end))


def session_id(path: Column, at: Column | None = None) -> Column:
    return F.concat(stem(path), F.lit("_"), F.date_format(at if at is not None else F.current_timestamp(), "yyyyMMdd_HHmmss"))


def media_type(path: Column) -> Column:
    out = F.lit("image/jpeg")
    for end, kind in MEDIA_TYPES.items():
        out = F.when(F.lower(path).endswith(end), kind).otherwise(out)
    return out
