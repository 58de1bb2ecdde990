"""Judgments: flat columns with defaults, and the merge of a page's images into one judgment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.functions.coerce import JsonField, judge_bool, judge_double, judge_int, round_mean, to_bool
from quireflow.functions.parsing import readability_name, readability_rank


def distortion_columns(payload: Column) -> list[Column]:
    """needs_dewarping, readability_issues and has_out_of_document of a judgment's JSON, with defaults."""
    get = lambda k: JsonField(payload, k)
    return [
        get("needs_dewarping").boolean(to_bool).alias("needs_dewarping"),
        F.coalesce(get("readability_issues").text, F.lit("none")).alias("readability_issues"),
        get("has_something_out_of_document").boolean(to_bool).alias("has_out_of_document"),
    ]


def summary_columns(payload: Column) -> list[Column]:
    """The short forms of the three judges in one row."""
    get = lambda k: JsonField(payload, k)
    level = F.coalesce(get("readability_issues").text, F.lit("none"))
    return [
        get("needs_dewarping").boolean(to_bool).alias("needs_dewarping"),
        level.alias("readability_issues"),
        (F.lower(level) == "major").alias("requires_reprocessing"),
        F.coalesce(get("confidence_score").double(judge_double), F.lit(0.0)).alias("confidence_score"),
        get("rotation_needed").boolean(to_bool).alias("rotation_needed"),
        F.coalesce(get("page_count").integer(judge_int), F.lit(1)).alias("page_count"),
    ]


def page_count_columns(payload: Column) -> list[Column]:
    """The fields of a page-count judgment, typed, as merge_judgments takes them."""
    get = lambda k: JsonField(payload, k)
    return [
        get("has_table_elements").boolean(judge_bool).alias("has_table_elements"),
        get("has_handwritten_notes_or_marks").boolean(judge_bool).alias("has_handwritten_notes_or_marks"),
        get("page_count").integer(judge_int).alias("page_count"),
        get("page_count_confidence").double(judge_double).alias("page_count_confidence"),
        get("confidence_score").double(judge_double).alias("confidence_score"),
        *(get(k).text.alias(k) for k in ("readability_issues", "readability_comment", "overall_comment")),
    ]


def one_image(success: Column, payload: Column) -> dict[str, Column]:
    """What :func:`merge_judgments` makes of a page with one image: page_count from 1 to 3, and the flags; of no answer the defaults."""
    own = F.struct(*page_count_columns(payload))
    flag = lambda c: F.coalesce(F.when(success, own[c]), F.lit(False))
    count = F.least(F.lit(3), F.greatest(F.lit(1), F.coalesce(F.when(success, own["page_count"]), F.lit(0))))
    return {"page_count": count.cast("int")} | {c: flag(c) for c in ("has_table_elements", "has_handwritten_notes_or_marks")}


def merge_judgments(images: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One judgment per page from those of its images.

    images: the keys, the order column, success, and has_table_elements,
    has_handwritten_notes_or_marks, page_count, page_count_confidence,
    confidence_score, readability_issues, readability_comment, overall_comment,
    typed (see page_count_columns) or as text.  Flags are true if any success says so, counts add up to 1 to 3, confidences
    are means to 3 places, readability is the worst, comments are numbered by
    the image's place among all images.  A page of failures alone is a success
    with defaults.
    """
    ok = F.coalesce(F.col("success"), F.lit(False))
    # a comment's number is its place among the page's images: found in the sorted array, so no window is needed
    kind = dict(images.dtypes)
    typed = lambda c, rule: rule(F.col(c)) if kind[c] == "string" else F.col(c)
    any_true = lambda c: F.coalesce(F.bool_or(F.when(ok, typed(c, judge_bool))), F.lit(False)).alias(c)
    mean = lambda c: round_mean(F.avg(F.when(ok, typed(c, judge_double)))).alias(c)
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.when(ok, F.col("readability_comment")).alias("r"), F.when(ok, F.col("overall_comment")).alias("c"))))
    merged = images.groupBy(*keys).agg(
        F.count("*").alias("images"),
        F.count_if(ok).alias("successful_images"),
        any_true("has_table_elements"),
        any_true("has_handwritten_notes_or_marks"),
        F.least(F.lit(3), F.greatest(F.lit(1), F.coalesce(F.sum(F.when(ok, typed("page_count", judge_int))), F.lit(0)))).cast("int").alias("page_count"),
        mean("page_count_confidence"),
        mean("confidence_score"),
        readability_name(F.max(F.when(ok, readability_rank(F.col("readability_issues"))))).alias("readability_issues"),
        rows.alias("__rows"),
    )

    def comments(field: str) -> Column:
        numbered = F.transform("__rows", lambda x, i: F.when(F.coalesce(x[field], F.lit("")) != "", F.concat(F.lit("img"), (i + 1).cast("string"), F.lit(": "), x[field])))
        return F.nullif(F.array_join(numbered, "\n"), F.lit(""))

    return merged.withColumns({"readability_comment": comments("r"), "overall_comment": comments("c"), "success": F.lit(True)}).drop("__rows")
