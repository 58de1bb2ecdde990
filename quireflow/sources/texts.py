"""Recognised text that earlier runs wrote."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.functions.coerce import strip
from quireflow.functions.names import basename, suffix
from quireflow.operators.routing import has_text
from quireflow.sources import files

#: Ends of file names by engine, after a star (fixed values).
ENGINE_FILES = {"llm": "*_ocr_result.txt", "document_ai": "*_documentai_result.txt"}


def text_parts(spark: SparkSession, path: str) -> DataFrame:
    """engine, filename, text, content_length of every non-empty result file below a path."""
    found = files.listed(spark, path, "*.txt")
    if found is None:
        df = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").text(path, wholetext=True)
        df = df.select(basename(F.input_file_name()).alias("filename"), "value")
    else:
        ours = functools.reduce(Column.__or__, (F.col("path").endswith(glob[1:]) for glob in ENGINE_FILES.values()))
        df = files.contents(found.filter(ours)).select(basename(F.col("path")).alias("filename"), F.col("content").cast("string").alias("value"))
    engine = F.coalesce(*(F.when(F.col("filename").endswith(glob[1:]), engine) for engine, glob in ENGINE_FILES.items()))
    out = df.select(engine.alias("engine"), "filename", strip(F.col("value")).alias("text")).filter("engine is not null")
    return out.filter(has_text(F.col("text"))).withColumn("content_length", F.length("text"))


def numeric_order(filename: Column) -> Column:
    """Page and mask of a result file's name as numbers, so that page 1000 follows page 999."""
    number = lambda word: F.nullif(F.regexp_extract(filename, rf"{word}_?(\d+)", 1), F.lit("")).try_cast("int")
    return F.struct(number("page").alias("page"), number("mask").alias("mask"), filename.alias("name"))


def body_of_text(content: Column) -> Column:
    """A text file's body: what follows the first line of ten dashes or more, stripped; else all of it."""
    lines = F.split(content, "\n")
    rule = F.transform(lines, lambda x: x.startswith("-" * 10))
    at = F.coalesce(F.array_position(rule, F.lit(True)).cast("int"), F.lit(0))
    rest = F.slice(lines, at + 1, F.greatest(F.size(lines) - at, F.lit(0)))
    return strip(F.array_join(rest, "\n"))


def saved_text(path: Column, content: Column) -> Column:
    """The text of a saved .txt or .json result; null for other files."""
    end = suffix(path)
    return F.when(end == ".txt", body_of_text(content)).when(end == ".json", F.coalesce(F.get_json_object(content, "$.ocr_result.extracted_text"), F.lit("")))
