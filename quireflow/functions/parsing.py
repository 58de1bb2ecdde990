"""Responses of recognizers and judges: fences, JSON, angles, ranks."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quireflow.functions.coerce import strip

JSON_FENCE = r"(?s)```json\s*(.*?)\s*```"
ANY_FENCE = r"(?s)```\s*(.*?)\s*```"
OUTER_BRACES = r"(?s)(\{.*\})"
READABILITY = ("none", "minor", "major")
#: Words for angles in answers (fixed values), by the angle they mean.
ANGLE_WORDS = {
    0: ("0", "none", "正しい", "正常"),
    90: ("90", "右90", "時計回り90"),
    -90: ("-90", "左90", "反時計回り90"),
    180: ("180", "上下逆", "逆さま"),
}


def captured(text: Column, pattern: str) -> Column:
    """First group of the first match, null where there is no match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def valid_json(text: Column) -> Column:
    """The text where it is one JSON value and nothing else, else null."""
    parsed = F.try_parse_json(text)
    closed = text.rlike(r'(?s)^\s*(\{.*\}|\[.*\]|".*"|true|false|null|-?\d[\d.eE+-]*)\s*$')
    return F.when(parsed.isNotNull() & closed, text)


def judgment_json(text: Column) -> Column:
    """The JSON of a judge's answer: inside a json fence, else the whole answer; null where it does not parse."""
    return valid_json(F.coalesce(captured(text, JSON_FENCE), strip(text)))


def ocr_candidate(text: Column) -> Column:
    """What of an answer is read as JSON: the first pattern that matches decides; an empty capture means the whole."""
    got = F.coalesce(captured(text, JSON_FENCE), captured(text, ANY_FENCE), captured(text, OUTER_BRACES))
    return F.coalesce(F.nullif(got, F.lit("")), strip(text))


@F.pandas_udf(StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    """Indented JSON, as a reader would print it."""
    return texts.map(lambda t: json.dumps(json.loads(t), ensure_ascii=False, indent=2), na_action="ignore")


def parse_ocr(df: DataFrame, response: str = "response") -> DataFrame:
    """Adds extracted_text and note (ok, no_field, not_json) of each answer, in one pass over the input.

    The intermediate columns are projections of their own, which keeps each
    generated method small.  Python only gets answers that are JSON without the
    field (for the indentation); for the others it sees a null.
    """
    own = df.withColumn("__text", strip(F.col(response))).withColumn("__candidate", ocr_candidate(F.col(response)))
    own = own.withColumn("__body", valid_json(F.col("__candidate")))
    keys = F.when(F.col("__body").rlike(r"(?s)^\s*\{"), F.json_object_keys("__body"))
    own = own.withColumn("__has", F.coalesce(F.array_contains(keys, "extracted_text"), F.lit(False)))
    own = own.withColumn("note", F.when(F.col("__body").isNull(), "not_json").when(F.col("__has"), "ok").otherwise("no_field"))
    printed = pretty_json(F.when(F.col("note") == "no_field", F.col("__body")))
    text = F.when(F.col("note") == "ok", F.get_json_object("__body", "$.extracted_text")).when(F.col("note") == "not_json", F.col("__text")).otherwise(printed)
    return own.withColumn("extracted_text", text).drop("__text", "__candidate", "__body", "__has")


def angle_bucket(degrees: Column) -> Column:
    """One of 0, 90, -90, 180 for a number of degrees; all beyond 135 either way is 180."""
    return (
        F.when(degrees.isNull(), 0)
        .when(degrees.between(-45, 45), 0)
        .when((degrees > 45) & (degrees <= 135), 90)
        .when((degrees >= -135) & (degrees < -45), -90)
        .otherwise(180)
    )


def angle_of_text(text: Column) -> Column:
    """An angle word, else the bucket of the first whole number in the text, else 0."""
    s = F.lower(strip(text))
    out = F.lit(None).cast("int")
    for angle, words in ANGLE_WORDS.items():
        out = F.when(s.isin(*words), angle).otherwise(out)
    found = F.nullif(F.regexp_extract(s, r"(?U)-?\d+", 0), F.lit("")).try_cast("int")
    return F.coalesce(out, angle_bucket(found))


def judged_angle(payload: Column) -> Column:
    """The angle of an orientation judgment: recommended_angle where the key exists, null included, else rotation_angle."""
    keys = F.json_object_keys(payload)
    text = F.when(F.array_contains(keys, "recommended_angle"), F.get_json_object(payload, "$.recommended_angle")).otherwise(F.get_json_object(payload, "$.rotation_angle"))
    return F.when(text.rlike(r"^-?\d+(\.\d+)?$"), angle_bucket(text.try_cast("double").try_cast("int"))).otherwise(angle_of_text(F.coalesce(text, F.lit(""))))


def readability_rank(level: Column) -> Column:
    """0, 1, 2 for none, minor, major in any case; null for anything else."""
    return F.nullif(F.array_position(F.array(*map(F.lit, READABILITY)), F.lower(level)), F.lit(0)) - 1


def readability_name(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, READABILITY)), (F.coalesce(rank, F.lit(0)) + 1).cast("int"))
