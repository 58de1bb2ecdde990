"""Recognizers and judges behind small interfaces, with retries and errors as rows.

A recognizer is built once per worker by a factory and may fail; a failure is
retried and at last becomes a row with success false.  Calls are paid for and
not repeatable, so what they return should be written as a table before it is
used twice; ``write_once`` does that by a key.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.config import Judge, Ocr
from quireflow.operators.summaries import document_ai_group


class Recognizer(Protocol):
    """Text of the ordered images of one group: the raw answer."""

    def __call__(self, images: list[Any]) -> str: ...


class ImageRecognizer(Protocol):
    """Text and confidence of one image."""

    def __call__(self, image: Any) -> tuple[str, float]: ...


class PageJudge(Protocol):
    """The raw answer of a judge about one image."""

    def __call__(self, image: Any) -> str: ...


class Unavailable(Exception):
    """The service is not set up: fail at once, without retries."""


def judge_once(judge: PageJudge, image: Any, cfg: Judge = Judge()) -> dict:
    """At most max_retries calls without pause; an answer that does not parse uses up a call."""
    error = "no attempt"
    for attempt in range(1, cfg.max_retries + 1):
        try:
            raw = judge(image)
            return {"success": True, "error": None, "payload": json.dumps(parse_judgment(raw), ensure_ascii=False), "raw_response": raw, "attempt": attempt}
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
    return {"success": False, "error": error, "payload": None, "raw_response": None, "attempt": cfg.max_retries}


def parse_judgment(raw: str) -> dict:
    """The object in a json fence, else the whole answer; anything else raises."""
    before, fence, rest = raw.partition("```json")
    body = rest.partition("```")[0] if fence and "```" in rest else raw
    out = json.loads(body.strip())
    if not isinstance(out, dict):
        raise ValueError("a judgment is an object")
    return out


def with_backoff(call: Callable[[], Any], cfg: Ocr = Ocr(), sleep: Callable[[float], None] = time.sleep) -> tuple[Any, str | None, int]:
    """(result, error, calls): one call and up to max_retries more after 1, 2, 4 ... seconds."""
    for n in range(cfg.max_retries + 1):
        try:
            return call(), None, n + 1
        except Unavailable as e:
            return None, str(e), n + 1
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        if n < cfg.max_retries:
            sleep(2.0**n)
    return None, error, cfg.max_retries + 1


#: What a judge adds to a row, and a recognizer of groups or of images.
_JUDGED = {"success": pa.bool_(), "error": pa.string(), "payload": pa.string(), "raw_response": pa.string(), "attempt": pa.int32()}
_ANSWERED = {"success": pa.bool_(), "error": pa.string(), "response": pa.string(), "processed_images": pa.int32(), "calls": pa.int32()}
_READ = {"success": pa.bool_(), "error": pa.string(), "text": pa.string(), "confidence": pa.float64()}
_SQL = {pa.bool_(): "boolean", pa.string(): "string", pa.int32(): "int", pa.float64(): "double"}


def _per_row(src: DataFrame, column: str, start: Callable[[], Callable[[Any], tuple]], made: dict[str, pa.DataType], label: tuple[str, str] | None = None, keep: bool = False) -> DataFrame:
    """The columns of ``src`` but ``column``, a label, and what a function makes of each value of ``column``, which may be kept.

    ``start`` builds the function once a partition.  One value is a Python
    object at a time; the others stay in their Arrow buffers.
    """
    carried = [c for c in src.columns if c != column]
    names = [*carried, *([label[0]] if label else []), *made, *([column] if keep else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = start()
        for batch in batches:
            rows = [own(x.as_py() if x.is_valid else None) for x in batch.column(column)]
            columns = [batch.column(c) for c in carried] + ([pa.array([label[1]] * len(rows), pa.string())] if label else [])
            columns += [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(made.values())]
            yield pa.RecordBatch.from_arrays([*columns, *([batch.column(column)] if keep else [])], names)

    kinds = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    kinds |= {k: _SQL[v] for k, v in made.items()} | ({label[0]: "string"} if label else {})
    return src.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names))


def judge_images(images: DataFrame, factory: Callable[[], PageJudge], image: str, keys: list[str], judge: str, cfg: Judge = Judge(), keep: bool = False) -> DataFrame:
    """keys, judge, success, error, payload, raw_response, attempt of each image, which ``keep`` keeps; a missing one is a failure without a call."""

    def start() -> Callable[[Any], tuple]:
        own = factory()
        return lambda x: (False, "missing image", None, None, 0) if x is None else tuple(judge_once(own, x, cfg).values())

    return _per_row(images.select(*keys, image), image, start, _JUDGED, ("judge", judge), keep)


def orientation_angles(images: DataFrame, factory: Callable[[], PageJudge] | None, image: str, keys: list[str], enabled: bool = True) -> DataFrame:
    """keys, success, error, angle: 0 where detection is off or has no judge, an error row for a missing image."""
    from quireflow.functions.parsing import judged_angle

    if not enabled or factory is None:
        return images.select(*keys, F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("angle"))
    judged = judge_images(images, factory, image, keys, "orientation")
    return judged.select(*keys, "success", "error", F.when(F.col("success"), judged_angle(F.col("payload"))).otherwise(0).alias("angle"))


def recognize_groups(groups: DataFrame, factory: Callable[[], Recognizer], keys: list[str], engine: str = "llm", cfg: Ocr = Ocr(), sleep: Callable[[float], None] = time.sleep, load: Callable[[Any], Any] | None = None) -> DataFrame:
    """Raw answers for groups (images: ordered array of structs with ``image``); images that are null are left out.

    At most max_concurrent_groups run at once: so many partitions call.  Where
    ``image`` is a path that ``load`` reads in the task, no pixels travel to them.
    """

    def start() -> Callable[[Any], tuple]:
        own = factory()

        def answer(images: list[dict] | None) -> tuple:
            present = [x["image"] for x in images or [] if x["image"] is not None]
            if not present:
                return False, "no images", None, 0, 0
            raw, error, calls = with_backoff(lambda: own([load(x) for x in present] if load else present), cfg, sleep)
            return error is None, error, raw, len(present), calls

        return answer

    return _per_row(groups.select(*keys, "images").repartition(cfg.max_concurrent_groups), "images", start, _ANSWERED, ("engine", engine))


def recognize_images(tiles: DataFrame, factory: Callable[[], ImageRecognizer], image: str, keys: list[str], cfg: Ocr = Ocr(), sleep: Callable[[float], None] = time.sleep, load: Callable[[Any], Any] | None = None) -> DataFrame:
    """keys, image_type, split_index, success, error, text, confidence of every tile; types are the tiles' own.

    The same bound on concurrent calls as for groups; a missing image is a
    failure without a call.
    """

    def start() -> Callable[[Any], tuple]:
        own = factory()

        def read(x: Any) -> tuple:
            if x is None:
                return False, "missing image", None, 0.0
            got, error, _ = with_backoff(lambda: own(load(x) if load else x), cfg, sleep)
            return error is None, error, *(got or (None, 0.0))

        return read

    return _per_row(tiles.select(*keys, "image_type", "split_index", image).repartition(cfg.max_concurrent_groups), image, start, _READ)


def document_ai_results(tiles: DataFrame, factory: Callable[[], ImageRecognizer], image: str, keys: list[str], cfg: Ocr = Ocr(), sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Per group: the fan-in of its images, the original first, then strips by number."""
    read = recognize_images(tiles, factory, image, keys, cfg, sleep)
    place = F.when(F.col("image_type") == "original", -1).otherwise(F.col("split_index"))
    return document_ai_group(read.withColumn("place", place), keys, "place").withColumn("engine", F.lit("document_ai"))


def individual_results(read: DataFrame, keys: list[str]) -> DataFrame:
    """keys and individual_results (a list of struct per image, the original first, then strips by number) of each group."""
    first = F.when(F.col("image_type") == "original", -1).otherwise(F.col("split_index")).alias("place")
    rows = F.array_sort(F.collect_list(F.struct(first, "image_type", "split_index", "success", "error", "text", "confidence")))
    return read.groupBy(*keys).agg(F.transform(rows, lambda x: x.dropFields("place")).alias("individual_results"))


def write_once(results: DataFrame, path: str) -> DataFrame:
    """Results of paid calls as a table, read back: nothing calls again for a second use."""
    results.write.mode("errorifexists").parquet(path)
    return results.sparkSession.read.parquet(path)


class StubRecognizer:
    """Deterministic stand-in: answers with the images joined; fails where a text asks for it."""

    def __call__(self, images: list[Any]) -> str:
        if any("<fail>" in str(x) for x in images):
            raise RuntimeError("asked to fail")
        return "```json\n" + json.dumps({"extracted_text": "\n".join(map(str, images))}, ensure_ascii=False) + "\n```"


class StubImageRecognizer:
    """Deterministic stand-in: the text itself, with a confidence by its length."""

    def __call__(self, image: Any) -> tuple[str, float]:
        if "<fail>" in str(image):
            raise RuntimeError("asked to fail")
        return str(image), round(min(1.0, len(str(image)) / 1000), 3)
