"""Summaries of stages.  Every ratio over nothing is 0; histograms are long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.sinks.committed import shared_folder


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _ok() -> Column:
    return F.coalesce(F.col("success"), F.lit(False))


def count_flag(name: str) -> Column:
    return F.count_if(F.coalesce(F.col(name), F.lit(False)))


def histogram(df: DataFrame, value: Column, missing: str | int | None = None, name: str = "value") -> DataFrame:
    """Rows by value; null counts as ``missing``."""
    return df.groupBy((F.coalesce(value, F.lit(missing)) if missing is not None else value).alias(name)).agg(F.count("*").alias("n"))


def as_map(histogram_: DataFrame, name: str = "value") -> DataFrame:
    """A histogram as one map."""
    return histogram_.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias("distribution"))


def render_summary(pages: DataFrame) -> DataFrame:
    """Pages rendered and failed; a stage succeeds if any page does."""
    return pages.agg(F.count("*").alias("total_pages"), F.count_if(_ok()).alias("successful_pages"), F.count_if(~_ok()).alias("failed_pages"), F.coalesce(F.bool_or(_ok()), F.lit(False)).alias("success"))


def render_totals(pages: DataFrame) -> DataFrame:
    """Totals of rendered pages (success, used_dpi, file_size_bytes): bytes and the mean resolution over successes."""
    size, dpi = F.when(_ok(), F.col("file_size_bytes")), F.when(_ok(), F.col("used_dpi"))
    out = pages.agg(F.count("*").alias("total"), F.count_if(_ok()).alias("successful"), F.coalesce(F.sum(size), F.lit(0)).alias("total_file_size_bytes"), F.coalesce(F.avg(dpi), F.lit(0.0)).alias("average_dpi"))
    return out.withColumns({"failed": F.col("total") - F.col("successful"), "success_rate": ratio(F.col("successful"), F.col("total"))})


def recognition_statistics(results: DataFrame, engines: tuple[str, str] = ("llm", "document_ai")) -> DataFrame:
    """One row over results of both engines (engine, success, extracted_text, files): groups read and failed, files, texts.

    files: how many files a result was written to.
    """
    aggs = []
    for e in engines:
        own, ok = F.col("engine") == e, (F.col("engine") == e) & _ok()
        aggs += [
            F.count_if(ok).alias(f"{e}_groups_processed"),
            F.count_if(own & ~_ok()).alias(f"{e}_groups_failed"),
            F.coalesce(F.sum(F.when(ok, F.col("files"))), F.lit(0)).cast("long").alias(f"{e}_files_created"),
            F.coalesce(F.avg(F.when(ok, F.length(F.coalesce("extracted_text", F.lit(""))))), F.lit(0.0)).alias(f"{e}_average_text_length"),
        ]
    out = results.agg(F.count_distinct("group_key").alias("total_groups"), *aggs)
    return out.withColumn("total_files_created", F.col(f"{engines[0]}_files_created") + F.col(f"{engines[1]}_files_created"))


def quality_summary(pages: DataFrame) -> DataFrame:
    """Step summary of page states (success, needs_dewarping, reprocessed_at_scale, dewarping_applied)."""
    out = pages.agg(F.count("*").alias("total_pages"), F.count_if(_ok()).alias("successful_pages"), count_flag("needs_dewarping").alias("needs_dewarping_count"), count_flag("reprocessed_at_scale").alias("reprocessed_count"), count_flag("dewarping_applied").alias("dewarped_count"))
    return out.withColumn("success_rate", ratio(F.col("successful_pages"), F.col("total_pages")))


def rerender_summary(results: DataFrame) -> DataFrame:
    """Totals of second renderings; the mean factor is over successes, one at least."""
    out = results.agg(F.count("*").alias("total"), F.count_if(_ok()).alias("successful"), F.coalesce(F.sum(F.when(_ok(), F.col("file_size_bytes"))), F.lit(0)).alias("total_file_size_bytes"), F.coalesce(F.sum(F.when(_ok(), F.col("scale_factor"))), F.lit(0.0)).alias("f"))
    return out.select("total", "successful", (F.col("total") - F.col("successful")).alias("failed"), ratio(F.col("successful"), F.col("total")).alias("success_rate"), "total_file_size_bytes", (F.col("f") / F.greatest(F.col("successful"), F.lit(1))).alias("average_scale_factor"))


def dewarp_summary(results: DataFrame) -> DataFrame:
    skip = F.coalesce(F.col("skipped"), F.lit(False))
    out = results.agg(F.count("*").alias("total"), F.count_if(_ok() & ~skip).alias("successful"), F.count_if(_ok() & skip).alias("skipped"), F.count_if(~_ok()).alias("failed"))
    return out.withColumns({"success_rate": ratio(F.col("successful"), F.col("total")), "skip_rate": ratio(F.col("skipped"), F.col("total"))})


def rotation_summary(images: DataFrame) -> DataFrame:
    """Images, those turned, and their share (success, angle)."""
    out = images.agg(F.count("*").alias("total_images"), F.count_if(_ok()).alias("successful_images"), F.count_if(_ok() & (F.col("angle") != 0)).alias("rotated_images"))
    return out.withColumn("rotation_rate", ratio(F.col("rotated_images"), F.col("total_images")))


def spread_summary(pages: DataFrame) -> DataFrame:
    """Merged judgments: counts of flags and the share of pages that were split."""
    out = pages.agg(F.count("*").alias("total_evaluations"), F.count_if(_ok()).alias("successful_evaluations"), F.count_if(_ok() & F.col("has_table_elements")).alias("has_table_elements"), F.count_if(_ok() & F.col("has_handwritten_notes_or_marks")).alias("has_handwritten_notes"), count_flag("split").alias("split_count"))
    return out.withColumns({"evaluation_success_rate": ratio(F.col("successful_evaluations"), F.col("total_evaluations")), "split_rate": ratio(F.col("split_count"), F.col("total_evaluations"))})


def ocr_summary(results: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Groups, text lengths and images of one engine's results, failures included."""
    length = F.length(F.coalesce("extracted_text", F.lit("")))
    out = results.groupBy(*keys).agg(F.count("*").alias("total_groups"), F.count_if(_ok()).alias("successful_groups"), F.count_if(~_ok()).alias("failed_groups"), F.coalesce(F.sum(F.when(_ok(), length)), F.lit(0)).alias("total_text_length"), F.coalesce(F.sum(F.when(_ok(), F.col("processed_images"))), F.lit(0)).alias("total_images_processed"))
    return out.withColumn("average_text_length", ratio(F.col("total_text_length"), F.col("successful_groups")))


def document_ai_group(images: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Fan-in of single images: counts, mean confidence over successes, stripped texts with a blank line between."""
    from quireflow.functions.coerce import strip

    text = F.when(_ok(), strip(F.col("text")))
    texts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    out = images.groupBy(*keys).agg(F.count("*").alias("processed_images"), F.count_if(_ok()).alias("successful_images"), F.count_if(~_ok()).alias("failed_images"), F.coalesce(F.avg(F.when(_ok(), F.col("confidence"))), F.lit(0.0)).alias("average_confidence"), texts.alias("__t"))
    joined = F.array_join(F.filter(F.transform("__t", lambda x: x["t"]), lambda t: F.coalesce(t, F.lit("")) != ""), "\n\n")
    return out.withColumns({"combined_text": joined, "success": F.col("successful_images") > 0}).drop("__t")


def token_confidence(confidences: Column) -> Column:
    """Mean of an array of token confidences, 0 where it is empty."""
    return F.when(F.size(F.coalesce(confidences, F.array().cast("array<double>"))) > 0, F.aggregate(confidences, F.lit(0.0), lambda a, x: a + x) / F.size(confidences)).otherwise(0.0)


def document_ai_summary(groups: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Run summary of grouped results; the overall confidence is over positive ones only, the rate is a percentage."""
    take = lambda c: F.coalesce(F.sum(F.when(_ok(), F.col(c))), F.lit(0))
    length = F.length(F.coalesce("combined_text", F.lit("")))
    out = groups.groupBy(*keys).agg(
        F.count("*").alias("total_groups"), F.count_if(_ok()).alias("successful_groups"), F.count_if(~_ok()).alias("failed_groups"),
        take("processed_images").alias("total_images_processed"), take("successful_images").alias("total_successful_images"), take("failed_images").alias("total_failed_images"),
        F.coalesce(F.avg(F.when(_ok() & (F.col("average_confidence") > 0), F.col("average_confidence"))), F.lit(0.0)).alias("overall_confidence"),
        F.coalesce(F.sum(F.when(_ok(), length)), F.lit(0)).alias("total_text_length"),
    )
    return out.withColumns({"average_text_length": ratio(F.col("total_text_length"), F.col("successful_groups")), "success_rate": ratio(F.col("successful_groups"), F.col("total_groups")) * 100})


def extraction_status(results: DataFrame) -> DataFrame:
    """Groups recognised by any engine; the rate is over one group at least, as a percentage."""
    groups = results.groupBy("group_key").agg(F.coalesce(F.bool_or(_ok()), F.lit(False)).alias("ok"))
    out = groups.agg(F.count("*").alias("total_groups"), F.count_if(F.col("ok")).alias("successful_groups"))
    return out.withColumn("success_rate", F.col("successful_groups") * 100.0 / F.greatest(F.col("total_groups"), F.lit(1)))


def in_page_order(pages: DataFrame, page: str, tie: str) -> DataFrame:
    """Rows with their place, from 1, by page number (a missing one counts as 0) and the tie's column.

    Rows are dealt by ranges of both columns, so that pages without a number
    are shared by tasks, too.  The sorted table is written, and a place is the
    number of rows in the parts before and the row's place in its own.
    """
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = pages.withColumn("__page", F.coalesce(F.col(page), F.lit(0))).repartitionByRange(parts, "__page", tie)
    own = own.sortWithinPartitions("__page", tie).drop("__page").withColumn("__m", F.monotonically_increasing_id())
    path = shared_folder(spark, "page-order")
    own.write.parquet(path)
    own = spark.read.schema(own.schema).parquet(path)
    sizes = own.groupBy(F.shiftright("__m", 33).alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))  # a row a part
    out = own.withColumn("__part", F.shiftright("__m", 33)).join(before, "__part")
    return out.withColumn("place", F.col("__before") + F.col("__m").bitwiseAND((1 << 33) - 1) + 1).drop("__part", "__m", "__before")
