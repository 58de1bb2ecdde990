"""Ordered integration of recognised parts into one text per group and engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.config import Integration
from quireflow.functions.coerce import strip
from quireflow.operators.routing import has_text


def join_parts(parts: Column, cfg: Integration = Integration()) -> Column:
    """Texts of an ordered array as one: two blank lines between parts, or a line feed without separators.

    Empty parts are left out; a part that is not the array's first keeps its
    leading separator even when all before it were empty.
    """
    if not cfg.include_separators:
        return F.array_join(F.filter(parts, lambda x: F.coalesce(x, F.lit("")) != ""), "\n")
    led = F.transform(parts, lambda x, i: F.when(F.coalesce(x, F.lit("")) != "", F.when(i > 0, F.concat(F.lit("\n\n"), x)).otherwise(x)))
    kept = F.array_join(F.filter(led, lambda x: x.isNotNull()), "\n")
    return kept


def integrate(parts: DataFrame, keys: list[str], order: list[Column], text: str = "text", cfg: Integration = Integration()) -> DataFrame:
    """files_count, integrated_text, total_characters per group of parts.

    Parts are stripped and empty ones dropped before they count, as when files
    are read; ``order`` decides their sequence, never the order of arrival.
    """
    own = parts.withColumn("__t", strip(F.col(text))).filter(has_text(F.col("__t")))
    sorted_ = F.array_sort(F.collect_list(F.struct(*(o.alias(f"o{k}") for k, o in enumerate(order)), F.col("__t").alias("t"))))
    out = own.groupBy(*keys).agg(F.count("*").alias("files_count"), F.transform(sorted_, lambda x: x["t"]).alias("__p"))
    return out.withColumn("integrated_text", join_parts(F.col("__p"), cfg)).drop("__p").withColumn("total_characters", F.length("integrated_text"))


def integration_summary(integrated: DataFrame, engines: tuple[str, str] = ("llm", "document_ai"), keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts of two engines side by side; an engine without text counts 0 and one error."""
    aggs = []
    for e in engines:
        own = F.col("engine") == e
        aggs += [F.coalesce(F.sum(F.when(own, F.col("files_count"))), F.lit(0)).alias(f"{e}_files"), F.coalesce(F.sum(F.when(own, F.col("total_characters"))), F.lit(0)).alias(f"{e}_characters")]
    out = integrated.groupBy(*keys).agg(*aggs)
    written = sum((F.col(f"{e}_characters") > 0).cast("int") for e in engines)
    return out.withColumns({"output_files": written, "total_errors": F.lit(len(engines)) - written, "success": written > 0})


def drop_overlap(parts: DataFrame, keys: list[str], order: str, text: str = "text", least: int = 8, most: int = 400) -> DataFrame:
    """Extension: cuts from each part the longest beginning (least to most characters) that ends the part before it."""
    from pyspark.sql import Window

    before = F.lag(text).over(Window.partitionBy(*keys).orderBy(order))
    own = parts.withColumn("__b", before)
    sizes = F.sequence(F.lit(least), F.greatest(F.lit(least), F.least(F.lit(most), F.length(text), F.length("__b"))))
    fits = F.filter(sizes, lambda n: F.col("__b").isNotNull() & (F.length(text) >= n) & (F.length("__b") >= n) & (F.right("__b", n) == F.left(text, n)))
    cut = F.coalesce(F.array_max(fits), F.lit(0))
    return own.withColumn(text, F.substring(F.col(text), cut + 1, F.length(text))).drop("__b")
