"""Scanned documents and images as tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.config import Render
from quireflow.functions.geometry import optimal_dpi, scaled_dpi
from quireflow.functions.names import page_image_name, session_id
from quireflow.operators.routing import document_failure, needs_rerender
from quireflow.sinks.committed import read_bytes
from quireflow.sources import files


class Document(Protocol):
    """An opened document; closed when its partition is done with it."""

    def page_count(self) -> int: ...
    def page_size(self, index: int) -> tuple[float, float]: ...
    def metadata(self) -> dict[str, str]: ...
    def render(self, index: int, dpi: int) -> tuple[int, int, bytes]: ...
    def close(self) -> None: ...


def documents(spark: SparkSession, path: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """session_id, path, content, modified, length of every document below a path."""
    found = files.listed(spark, path, glob)
    if found is None:
        df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        df = df.withColumnRenamed("modificationTime", "modified")
    else:
        df = files.contents(found)
    return df.select(session_id(F.col("path"), F.col("modified")).alias("session_id"), "path", "content", "modified", "length")


def first_document(docs: DataFrame) -> DataFrame:
    """The first document by path."""
    return docs.orderBy("path").limit(1)


def pages(docs: DataFrame, opener: Callable[[bytes], Document]) -> DataFrame:
    """A row per page: session_id, path, page_number from 1, total_pages, width and height in points, or one error row.

    The opened document lives inside its partition only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple[Any, ...]] = []
            for session, path, content in zip(pdf["session_id"], pdf["path"], pdf["content"], strict=True):
                try:
                    doc = opener(bytes(content))
                    try:
                        total = doc.page_count()
                        if total < 1:
                            raise ValueError("no pages")
                        rows += [(session, path, True, None, k + 1, total, *map(float, doc.page_size(k))) for k in range(total)]
                    finally:
                        doc.close()
                except Exception as e:
                    rows.append((session, path, False, f"{type(e).__name__}: {e}", None, None, None, None))
            yield pd.DataFrame(rows, columns=names).astype({"page_number": "Int32", "total_pages": "Int32"})

    names = ["session_id", "path", "success", "error", "page_number", "total_pages", "width", "height"]
    return docs.select("session_id", "path", "content").mapInPandas(run, "session_id string, path string, success boolean, error string, page_number int, total_pages int, width double, height double")


def document_metadata(docs: DataFrame, opener: Callable[[bytes], Document]) -> DataFrame:
    """session_id, path, success, error, metadata (the document's own entries, text by name)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple[Any, ...]] = []
            for session, path, content in zip(pdf["session_id"], pdf["path"], pdf["content"], strict=True):
                try:
                    doc = opener(bytes(content))
                    try:
                        rows.append((session, path, True, None, {str(k): str(v) for k, v in doc.metadata().items()}))
                    finally:
                        doc.close()
                except Exception as e:
                    rows.append((session, path, False, f"{type(e).__name__}: {e}", None))
            yield pd.DataFrame(rows, columns=["session_id", "path", "success", "error", "metadata"])

    return docs.select("session_id", "path", "content").mapInPandas(run, "session_id string, path string, success boolean, error string, metadata map<string,string>")


def document_info(docs: DataFrame, opener: Callable[[bytes], Document], cfg: Render = Render()) -> DataFrame:
    """Pages, size of the first page and the suggested resolution of each document; why it is not valid."""
    rows = pages(docs, opener)
    first = rows.filter("page_number = 1 or not success")
    failure = document_failure(F.col("total_pages"), F.col("success"))
    return first.select("session_id", "path", failure.isNull().alias("valid"), "error", failure.alias("failure"), "total_pages", "width", "height", optimal_dpi(F.col("width"), F.col("height"), cfg).alias("suggested_dpi"))


#: Pages of a document that one task renders at a time.
PAGES_PER_RANGE = 64
#: Bytes and pages that a task draws before it gives them on.
RENDERED_BYTES, RENDERED_ROWS = 4_000_000, 1000
_RENDERED = "path string, page_number int, used_dpi int, success boolean, error string, width int, height int, image binary"


def _wanted(page_rows: DataFrame, keys: list[str], dpi: str) -> DataFrame:
    """The keys with the numbers and resolutions of their pages, in order."""
    one = F.struct(F.col("page_number").cast("int").alias("page_number"), F.col(dpi).cast("int").alias("dpi"))
    own = page_rows.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("wanted"))
    return own.select(*keys, F.col("wanted.page_number").alias("numbers"), F.col("wanted.dpi").alias("dpis"))


def _rendered(opener: Callable[[bytes], Document], read: Callable[[pa.Scalar], bytes], given: str, carry: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (path, numbers, dpis and the column to read bytes from) as one row a page, some megabytes a batch; an error is a row."""
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    names = [x.split()[0] for x in _RENDERED.split(", ")]

    def given_out(batch: pa.RecordBatch, places: list[int], rows: list[tuple[Any, ...]]) -> pa.RecordBatch:
        own = [batch.column(c).take(pa.array(places)) for c in carry]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True))], [*carry, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("path", "numbers", "dpis")]
            places, rows, size = [], [], 0
            for at, (path, numbers, dpis) in enumerate(zip(*lists, strict=True)):
                doc, broken = None, None
                try:
                    doc = opener(read(batch.column(given)[at]))
                except Exception as e:
                    broken = e
                for page, dpi in zip(numbers, dpis, strict=True):
                    try:
                        if broken is not None:
                            raise broken
                        row = (True, None, *doc.render(page - 1, dpi))
                    except Exception as e:
                        row = (False, f"{type(e).__name__}: {e}", None, None, None)
                    places.append(at)
                    rows.append((path, page, dpi, *row))
                    size += len(row[-1] or b"")
                    if size >= RENDERED_BYTES or len(rows) == RENDERED_ROWS:
                        yield given_out(batch, places, rows)
                        places, rows, size = [], [], 0
                if doc is not None:
                    doc.close()
            if rows:
                yield given_out(batch, places, rows)

    return run


def _with_names(out: DataFrame) -> DataFrame:
    return out.withColumns({"output_path": page_image_name(F.col("path"), F.col("page_number")), "zoom_factor": F.col("used_dpi") / 72.0, "file_size_bytes": F.octet_length("image").cast("long")})


def render_pages(docs: DataFrame, page_rows: DataFrame, opener: Callable[[bytes], Document], dpi: str = "dpi", carry: list[str] | None = None) -> DataFrame:
    """Rendered images (output_path, width, height, image bytes) of page rows at their resolution; failures are rows.

    A document meets its pages once, is opened once, and gives some megabytes of
    images at a time.  ``carry`` are columns of the documents that each page gets.
    """
    carry = carry or []
    own = _wanted(page_rows, ["path"], dpi).join(docs.select("path", "content", *carry), "path")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*carry).schema.fields)
    return _with_names(own.mapInArrow(_rendered(opener, lambda x: x.as_py(), "content", carry), fields + _RENDERED))


def render_files(page_rows: DataFrame, opener: Callable[[bytes], Document], dpi: str = "dpi", size: int = PAGES_PER_RANGE) -> DataFrame:
    """As :func:`render_pages`, of files: only paths and page numbers travel, and a long document is shared by tasks.

    The pages of a document are dealt by ranges of ``size``; a range reads the
    file once, from where its path says it is.  There are as many tasks as the
    session has shuffle partitions: by the few bytes of its keys adaptive
    execution would give all work to one.
    """
    at = F.floor((F.col("page_number") - 1) / size).alias("page_range")
    tasks = int(page_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = page_rows.select("path", "page_number", F.col(dpi).alias("dpi"), at).repartition(tasks, "path", "page_range")
    own = _wanted(dealt, ["path", "page_range"], "dpi")
    return _with_names(own.mapInArrow(_rendered(opener, lambda x: read_bytes(x.as_py()), "path", []), _RENDERED))


def rerender(docs: DataFrame, states: DataFrame, opener: Callable[[bytes], Document], cfg: Render = Render()) -> DataFrame:
    """Pages judged hardly readable, rendered again at a higher resolution under a name of their own."""
    own = states.filter(needs_rerender(F.col("success"), F.col("readability_issues"))).withColumn("dpi", scaled_dpi(F.col("used_dpi"), cfg=cfg))
    out = render_pages(docs, own, opener)
    return out.withColumn("output_path", page_image_name(F.col("path"), F.col("page_number"), "_rescaled.jpg"))


def images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Decoded images of a folder or several; what cannot be decoded is a row with success false."""
    df = spark.read.format("image").option("dropInvalid", "false").load(path)
    return df.select(F.col("image.origin").alias("path"), (F.col("image.height") > 0).alias("success"), "image")


#: Files that Spark's index has on the driver at a time, and what opening one counts for when they are dealt to tasks.
ROUND_FILES, OPEN_BYTES = 20_000, 16_384


def rounds(spark: SparkSession, path: str, most: int = ROUND_FILES) -> list[list[str]] | None:
    """The folders below a path in lists of ``most`` files (one folder at least); None where tasks can't list them."""
    found = files.listed(spark, path)
    if found is None:
        return None
    folder = F.regexp_replace("path", "/[^/]*$", "")
    out: list[list[str]] = []
    room = 0
    for row in found.groupBy(folder.alias("folder")).count().orderBy("folder").collect():  # a row a folder
        if not out or row["count"] > room:
            out.append([])
            room = most
        out[-1].append(row.folder)
        room -= row["count"]
    return out


def decoded_images(spark: SparkSession, path: str, to: str) -> DataFrame:
    """As :func:`images`, of all folders below a path, as a table at ``to``.

    Only Spark's source decodes, and its index of files is the driver's, so some
    folders are read at a time: more files make more rounds, not a larger driver.
    A folder is never divided.
    """
    parts = rounds(spark, path)
    if parts is None:
        return images(spark, path)
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, OPEN_BYTES)  # else a task takes a few files only
    try:
        for folders in parts or [path]:
            images(spark, folders).write.mode("append").parquet(to)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(images(spark, parts[0][:1] if parts else path).schema).parquet(to)


def image_info(spark: SparkSession, path: str) -> DataFrame:
    """width, height, channels and bytes of image files."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    decoded = images(spark, path).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "success", "image.width", "image.height", "image.nChannels")
    return files.join(decoded, "path", "left")


def encoded(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds base64 text of a binary column; null stays null."""
    return df.withColumn("base64", F.base64(content))
