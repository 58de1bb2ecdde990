"""Writers.  Everything is partitioned by session, so no run reads another's files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.config import Ocr
from quireflow.functions.coerce import strip
from quireflow.functions.jpeg import encoder
from quireflow.operators.images import pixels_of
from quireflow.sinks.committed import write_named


def result_json(cfg: Ocr = Ocr(), extra: dict[str, Column] | None = None) -> Column:
    """JSON of one recognition result; warnings win over notes, extra fields over all."""
    fields: dict[str, Column] = {"success": F.coalesce("success", F.lit(False)), "ocr_result": F.struct(F.col("extracted_text").alias("extracted_text"))}
    if cfg.include_metadata:
        fields["group_info"] = F.struct("group_key", "processed_images")
        fields["warnings"] = F.when(F.col("note") == "no_field", F.array("note"))
        fields["processing_notes"] = F.when(F.col("note") == "not_json", F.array("note"))
        fields["raw_response"] = F.col("response")
    return F.to_json(F.struct(*(c.alias(k) for k, c in (fields | (extra or {})).items())))


def document_ai_json(cfg: Ocr = Ocr(), extra: dict[str, Column] | None = None) -> Column:
    inner = F.struct("combined_text", "processed_images", "successful_images", "failed_images", "average_confidence")
    fields: dict[str, Column] = {"success": F.coalesce("success", F.lit(False)), "document_ai_result": inner}
    if cfg.include_metadata:
        fields["group_info"] = F.struct("group_key")
        if cfg.include_individual_results:
            fields["individual_results"] = F.col("individual_results")
    return F.to_json(F.struct(*(c.alias(k) for k, c in (fields | (extra or {})).items())))


def metadata_json(summary: Column) -> Column:
    """Integration metadata of a session; both outputs are named, written or not."""
    name = lambda e: F.concat(F.lit(f"{e}_integrated_"), F.col("session_id"), F.lit(".txt"))
    return F.to_json(F.struct("session_id", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("processing_timestamp"), summary.alias("integration_summary"), F.struct(name("llm").alias("llm_integrated"), name("document_ai").alias("document_ai_integrated")).alias("output_files")))


def write_json(df: DataFrame, path: str, body: Column) -> None:
    df.select("session_id", body.alias("value")).write.mode("append").partitionBy("session_id").text(path)


def group_info() -> Column:
    """What a successful recognition result says about its group."""
    return F.struct("group_key", "page_number", "source_mask_index", F.col("processed_images").alias("image_count"))


def write_files(rows: DataFrame, folder: str) -> dict[str, str]:
    """A file for each row (name, content: text or bytes) below a folder of any file system, all of them or none.

    The result is empty; what keeps the job from writing is raised as OSError.
    """
    try:
        write_named(rows, folder)
    except Exception as e:
        raise OSError(f"{folder}: {e}") from e
    return {}


#: What the files of an engine's results are called after their group (fixed values).
RESULT_SUFFIX = {"llm": "_ocr_result", "document_ai": "_documentai_result"}


def result_files(results: DataFrame, engine: str, body: Column, cfg: Ocr = Ocr()) -> dict[str, DataFrame]:
    """name and content of a file per group by format: ``session/group_suffix.txt`` with the text, ``.json`` with ``body``."""
    stem = F.concat("session_id", F.lit("/"), "group_key", F.lit(RESULT_SUFFIX[engine]))
    out = {}
    if cfg.output_format in ("txt", "both"):
        out["txt"] = results.filter("success").select(F.concat(stem, F.lit(".txt")).alias("name"), strip(F.coalesce("extracted_text", F.lit(""))).alias("content"))
    if cfg.output_format in ("json", "both"):
        out["json"] = results.filter("success").select(F.concat(stem, F.lit(".json")).alias("name"), body.alias("content"))
    return out


def write_result_files(results: DataFrame, folder: str, engine: str, body: Column, cfg: Ocr = Ocr()) -> dict[str, str | None]:
    """Result files of one engine; per format an error or None."""

    def job(rows: DataFrame) -> Callable[[], None]:
        def write() -> None:
            write_files(rows, folder)

        return write

    return run_sinks({kind: job(rows) for kind, rows in result_files(results, engine, body, cfg).items()})


def judgment_files(judgments: DataFrame, kind: str) -> DataFrame:
    """name and content of a JSON file for every judgment that succeeded: a page's, or one of several images'."""
    image = F.when(F.col("image_idx") > 0, F.format_string("_img%d", F.col("image_idx"))).otherwise("")
    name = F.concat("session_id", F.lit("/"), F.format_string(f"page_%03d_{kind}", F.col("page_number")), image, F.lit(".json"))
    return judgments.filter("success").select(name.alias("name"), F.col("payload").alias("content"))


def jpeg(quality: int = 95) -> Callable[[np.ndarray], bytes]:
    """An encoder of pixels as JPEG."""
    return encoder(quality)


def netpbm(pixels: np.ndarray) -> bytes:
    """Pixels as a binary PGM or PPM file, which needs no library."""
    h, w, c = pixels.shape
    return f"P{5 if c == 1 else 6} {w} {h} 255\n".encode() + np.ascontiguousarray(pixels if c == 1 else pixels[..., 2::-1]).tobytes()


#: Bytes of files that a task encodes before it gives them on.
FILE_BYTES = 4_000_000


def image_files(images: DataFrame, name: Column, encoder: Callable[[], Callable[[np.ndarray], bytes]], image: str = "image") -> DataFrame:
    """name and content of an encoded file for every image struct; what cannot be encoded has content null and an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            start, contents, errors, size = 0, [], [], 0
            for at in range(batch.num_rows):
                own, content, error = batch.column(1)[at], None, None
                try:
                    row = {k: own[k].as_py() for k in ("height", "width", "nChannels")}
                    content = encode(pixels_of(row | {"data": own["data"].as_buffer()}))
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                contents.append(content)
                errors.append(error)
                size += len(content or b"")
                if size >= FILE_BYTES or at + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(contents)), pa.array(contents, pa.binary()), pa.array(errors, pa.string())], ["name", "content", "error"])
                    start, contents, errors, size = at + 1, [], [], 0

    return images.select(name.alias("name"), image).mapInArrow(run, "name string, content binary, error string")


def integrated_files(integrated: DataFrame) -> DataFrame:
    """name and content of the integrated text of each session and engine; an empty text is no file."""
    name = F.concat("session_id", F.lit("/"), "engine", F.lit("_integrated_"), "session_id", F.lit(".txt"))
    return integrated.filter("total_characters > 0").select(name.alias("name"), F.col("integrated_text").alias("content"))


def file_lists(results: DataFrame) -> DataFrame:
    """session_id, files (sorted), file_count: the lists of names of all results of a session as one."""
    return results.groupBy("session_id").agg(F.array_sort(F.flatten(F.collect_list("files"))).alias("files")).withColumn("file_count", F.size("files"))


def write_results(results: DataFrame, path: str, body: Column, cfg: Ocr = Ocr()) -> dict[str, str | None]:
    """Results as txt, json or both below ``path``; per format an error or None."""
    jobs: dict[str, Callable[[], None]] = {}
    if cfg.output_format in ("txt", "both"):
        jobs["txt"] = lambda: results.filter("success").select("session_id", F.coalesce("extracted_text", F.lit("")).alias("value")).write.mode("append").partitionBy("session_id").text(f"{path}/txt")
    if cfg.output_format in ("json", "both"):
        jobs["json"] = lambda: write_json(results, f"{path}/json", body)
    return run_sinks(jobs)


def run_sinks(jobs: dict[str, Callable[[], None]]) -> dict[str, str | None]:
    """Run every sink; one that fails does not stop the others.  A run succeeded if any value is None."""
    out: dict[str, str | None] = {}
    for name, job in jobs.items():
        try:
            job()
            out[name] = None
        except Exception as e:
            out[name] = f"{type(e).__name__}: {e}"
    return out


def write_integrated(integrated: DataFrame, path: str) -> None:
    """Integrated texts by session and engine; an empty text is no file."""
    integrated.filter("total_characters > 0").select("session_id", "engine", F.col("integrated_text").alias("value")).write.mode("append").partitionBy("session_id", "engine").text(path)


def write_summary(summary: DataFrame, path: str, session: str, processor: str) -> None:
    """A run's one-row summary with session, processor and time."""
    own = summary.withColumns({"generation_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"), "session_id": F.lit(session), "processor_type": F.lit(processor)})
    own.coalesce(1).write.mode("append").json(path)


def write_judgments(judgments: DataFrame, path: str) -> None:
    """Judgments that succeeded, as JSON."""
    judgments.filter("success").write.mode("append").partitionBy("session_id").json(path)


def write_images(images: DataFrame, path: str) -> None:
    """Image structs as a table, by session; bytes stay in their own column."""
    images.write.mode("append").partitionBy("session_id").parquet(path)
