"""Whole documents through all seven stages, with flags, stored answers and continue-on-failure.

Every stage takes the page records of the one before and gives them back with
its own columns.  A stage that is off, has no component or fails passes its
records on; only rendering is fatal.  What a stage returns is written as a
table before the next begins: a stage fails where it runs, a paid call is made
once, a lost executor costs a re-read, and a run into the same folder goes on
after the last stage that was finished.  Pixels pass through a judge beside its
answer and meet no join; only pages rendered again join their records.
"""

from __future__ import annotations

import dataclasses
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.config import Judge, Settings, apply_options
from quireflow.functions.geometry import optimal_dpi, scaled_dpi, spread_regions
from quireflow.functions.names import group_key
from quireflow.functions.parsing import judged_angle, parse_ocr
from quireflow.operators import images, integration, judgments, recognition, routing, tiles
from quireflow.plans.store import Store, fingerprint
from quireflow.sources import scans

log = logging.getLogger(__name__)

PAGE = ["session_id", "page_number"]
MASK = [*PAGE, "source_mask_index"]
GROUP = [*MASK, "group_key"]
#: The stages in order; the number of the last that succeeded names the final result.
STAGES = ["render", "judge", "rotate", "split", "tile", "recognize", "integrate"]


@dataclass(frozen=True)
class Components:
    """Factories of what the stages call; one that is None leaves its stage without it."""

    opener: Callable[[bytes], scans.Document]
    decoder: Callable[[Any], Any] | None = None
    distortion: Callable[[], recognition.PageJudge] | None = None
    orientation: Callable[[], recognition.PageJudge] | None = None
    page_count: Callable[[], recognition.PageJudge] | None = None
    detector: Callable[[], images.Detector] | None = None
    llm: Callable[[], recognition.Recognizer] | None = None
    document_ai: Callable[[], recognition.ImageRecognizer] | None = None
    sleep: Callable[[float], None] = time.sleep

    def ready(self) -> dict[str, bool]:
        """Which components there are, by name."""
        return {f.name: getattr(self, f.name) is not None for f in dataclasses.fields(self)}

    def have(self, *names: str) -> bool:
        """Are all of these there?  A stage without what it needs is left out."""
        return all(self.ready()[n] for n in names)


@dataclass
class Run:
    """What a run gives: the records of each stage, what went wrong by stage, and the integrated text."""

    settings: Settings
    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    #: Tables that an earlier run into the same store had finished.
    reused: list[str] = field(default_factory=list)

    @property
    def success(self) -> bool:
        return bool(self.tables)

    @property
    def final_stage(self) -> str | None:
        """The last stage that succeeded."""
        return next((s for s in reversed(STAGES) if s in self.tables), None)

    @property
    def result(self) -> DataFrame | None:
        return self.tables.get(self.final_stage) if self.final_stage else None

    def stats(self) -> dict[str, Any]:
        """The run in plain values: stages, errors and every setting."""
        return {"success": self.success, "final_stage": self.final_stage, "stages": list(self.tables), "skipped": self.skipped, "errors": self.errors, "settings": dataclasses.asdict(self.settings)}


class Prefixed(logging.Formatter):
    """Lines that say where they come from; warnings and errors are marked."""

    MARKS = {logging.WARNING: "! ", logging.ERROR: "!! ", logging.CRITICAL: "!!! "}

    def __init__(self) -> None:
        super().__init__("%(asctime)s %(levelname)s %(name)s: %(message)s")

    def format(self, record: logging.LogRecord) -> str:
        return self.MARKS.get(record.levelno, "") + super().format(record)


#: Loggers that are chatty at INFO; they are held to warnings.
QUIET = ("py4j", "py4j.clientserver", "urllib3")


def set_up_logging(level: str = "INFO", path: str | None = None) -> logging.Logger:
    """The driver's log, to a file as well where one is named; setting it up again changes the level only."""
    own = logging.getLogger("quireflow")
    own.setLevel(getattr(logging, level.upper(), logging.INFO))
    for name in QUIET:
        logging.getLogger(name).setLevel(logging.WARNING)
    have = {getattr(h, "baseFilename", None) for h in own.handlers}
    for handler, name in ((logging.StreamHandler(), None), *([(logging.FileHandler(path, delay=True), path)] if path else [])):
        if (handler.baseFilename if name else None) not in have:
            handler.setFormatter(Prefixed())
            own.addHandler(handler)
    return own


def render(docs: DataFrame, components: Components, settings: Settings, keep: Store) -> DataFrame:
    """Page records with their image, one a page; pages that fail are records without one."""
    sized = keep(scans.pages(docs, components.opener), "sized")
    wanted = sized.filter("success").withColumn("dpi", optimal_dpi(F.col("width"), F.col("height"), settings.render))
    drawn = scans.render_pages(docs, wanted, components.opener, carry=["session_id"])
    drawn = drawn.select("session_id", "path", "page_number", "success", "error", "used_dpi", _image("width", "height", "image").alias("image"))
    failed = sized.filter("not success").select("session_id", "path", F.coalesce("page_number", F.lit(0)).alias("page_number"), "success", "error")
    return drawn.unionByName(failed, allowMissingColumns=True)


def _image(width: str, height: str, data: str) -> F.Column:
    """An image struct of raw bytes; the number of channels follows from their length."""
    channels = F.try_divide(F.octet_length(data), F.col(width) * F.col(height)).cast("int")
    own = F.struct(F.lit("").alias("origin"), F.col(height).cast("int").alias("height"), F.col(width).cast("int").alias("width"), channels.alias("nChannels"), F.lit(0).alias("mode"), F.col(data).alias("data"))
    return F.when(F.col(data).isNotNull() & F.coalesce(channels > 0, F.lit(False)), own)


def _judged(pages: DataFrame, factory: Callable[[], recognition.PageJudge], kind: str, cfg: Judge, keep: Store, name: str) -> DataFrame:
    """The records with ``answered`` and ``payload`` of a judge; records that failed are not judged."""
    aside = {"success": "page_success", "error": "page_error"}
    own = pages.filter("success").withColumnsRenamed(aside)
    seen = recognition.judge_images(own, factory, "image", [c for c in own.columns if c != "image"], kind, cfg, keep=True)
    seen = seen.withColumnRenamed("success", "answered").drop("judge", "error", "raw_response", "attempt").withColumnsRenamed({v: k for k, v in aside.items()})
    rest = pages.filter(~F.coalesce("success", F.lit(False))).withColumns({"answered": F.lit(False), "payload": F.lit(None).cast("string")})
    return keep(seen.unionByName(rest), name)


def judge(pages: DataFrame, docs: DataFrame, components: Components, settings: Settings, keep: Store) -> DataFrame:
    """Distortion judged; hardly readable pages rendered at a higher resolution, warped ones straightened."""
    seen = _judged(pages, components.distortion, "distortion", settings.judge, keep, "judged")
    flat = {c: F.when(F.col("answered"), F.col(f"payload.{c}")) for c in ("needs_dewarping", "readability_issues", "has_out_of_document")}
    own = seen.withColumn("payload", F.struct(*judgments.distortion_columns(F.col("payload")))).withColumns(flat)
    own = own.withColumnRenamed("answered", "judged").drop("payload")
    own = own.withColumns({"reprocessed_at_scale": F.lit(False), "dewarping_applied": F.lit(False)})
    hard = F.col("success") & routing.needs_rerender(F.col("judged"), F.col("readability_issues"))
    again = own.filter(hard).select(*PAGE, "path", scaled_dpi(F.col("used_dpi"), cfg=settings.render).alias("dpi"))
    better = scans.render_pages(docs, again, components.opener, carry=["session_id"]).filter("success")
    better = better.select("session_id", "path", "page_number", F.col("used_dpi").alias("new_dpi"), _image("width", "height", "image").alias("new"))
    better = keep(better.filter("new is not null"), "rerendered")
    new = own.filter(hard).drop("image").join(better, [*PAGE, "path"])
    new = new.withColumns({"image": F.col("new"), "used_dpi": F.col("new_dpi"), "reprocessed_at_scale": F.lit(True)}).drop("new", "new_dpi")
    kept = own.filter(hard).join(better.select(*PAGE, "path"), [*PAGE, "path"], "left_anti")
    own = own.filter(~F.coalesce(hard, F.lit(False))).unionByName(kept).unionByName(new)
    if not settings.dewarp.enabled or components.detector is None:
        return own
    own = keep(own, "refined")
    keep.drop("judged", "rerendered")
    warped = F.coalesce(F.col("success") & F.col("judged") & F.col("needs_dewarping"), F.lit(False))
    done = F.col("warp_error").isNull() & ~F.col("skipped")
    flat = _dewarped(own.filter(warped), components, settings).withColumn("dewarping_applied", done)
    return own.filter(~warped).unionByName(flat.drop("warp_error", "skipped"))


def _dewarped(own: DataFrame, components: Components, settings: Settings) -> DataFrame:
    """Straightened images beside the record's own error column."""
    out = images.dewarp_images(own.withColumnRenamed("error", "page_error"), components.detector, cfg=settings.dewarp, compat=settings.compat)
    return out.withColumnRenamed("error", "warp_error").withColumnRenamed("page_error", "error")


def rotate(pages: DataFrame, components: Components, settings: Settings, keep: Store) -> DataFrame:
    """Each image turned by its judged angle; a judgment or a turn that fails leaves the image."""
    if settings.orientation.enabled and settings.orientation.use_llm and components.orientation is not None:
        own = _judged(pages, components.orientation, "orientation", Judge(), keep, "angles")
        own = own.withColumn("angle", F.coalesce(F.when(F.col("answered"), judged_angle(F.col("payload"))), F.lit(0))).drop("answered", "payload")
    else:
        own = pages.withColumn("angle", F.lit(0))
    turned = images.rotate_images(own.withColumnRenamed("error", "page_error"), compat=settings.compat)
    return turned.withColumn("rotated_count", (F.col("angle") != 0).cast("int")).drop("error").withColumnRenamed("page_error", "error")


def split(pages: DataFrame, components: Components, settings: Settings, keep: Store) -> DataFrame:
    """Pages judged, spreads cut into two images; one record an image, numbered from 0 in a page."""
    own = pages.withColumn("page_count", F.lit(1))
    if components.page_count is not None:
        own = _judged(pages, components.page_count, "page_count", settings.judge, keep, "counted")
        own = own.withColumns(judgments.one_image(F.col("answered"), F.col("payload"))).drop("answered", "payload")
    width = F.col("image.width")
    whole = F.array(F.struct(F.lit("whole").alias("side"), F.lit(0).alias("start"), width.alias("end")))
    spread = routing.should_split(F.col("page_count"), F.lit(False), F.array("image")) & F.col("success") & F.lit(settings.steps.split)
    parts = F.when(spread, spread_regions(width, settings.tiling.overlap_ratio)).otherwise(whole)
    own = own.select("*", F.posexplode(parts).alias("source_mask_index", "part")).select(*own.columns, "source_mask_index", F.col("part.side").alias("side"), F.col("part.start").alias("start_x"), F.col("part.end").alias("end_x"))
    own = own.withColumnRenamed("error", "page_error")
    cut = images.cut_columns(own.filter("side != 'whole'"))
    left = own.filter("side = 'whole'").withColumn("error", F.lit(None).cast("string"))
    return left.unionByName(cut).withColumn("error", F.coalesce("page_error", "error")).drop("page_error")


def _tiles(own: DataFrame, settings: Settings) -> DataFrame:
    """A record per strip and original of rows (MASK, height)."""
    return tiles.tile_records(own, F.col("height"), settings.tiling).withColumn("group_key", group_key(F.col("page_number"), F.col("source_mask_index")))


def tile(pages: DataFrame, settings: Settings) -> DataFrame:
    """A record per strip and original, with its own pixels; strips are slices of row-major bytes."""
    own = pages.filter(F.col("success") & F.col("image").isNotNull()).select(*MASK, "image", F.col("image.height").alias("height"))
    return _tiles(own, settings).withColumn("image", images.slice_rows(F.col("image"), F.col("start_y"), F.col("end_y")))


def recognize(sources: DataFrame, components: Components, settings: Settings, keep: Store, folder: str) -> DataFrame:
    """engine, success, error, extracted_text, note and counts of every group, in long form.

    The sources' pixels are written side by side to a file a task below
    ``folder``, a strip is some rows of one; only the references travel to the few
    partitions that call, which read them.
    """
    if components.llm is None and components.document_ai is None:
        raise recognition.Unavailable("no recognizer")
    out = []
    none = F.lit(None)
    drawn = sources.filter(F.col("success") & F.col("image").isNotNull()).select(*MASK, "image", F.col("image.height").alias("height"))
    placed = keep(images.packed(drawn, folder), "placed")
    lines = F.concat(F.lit(":"), F.col("start_y"), F.lit("-"), F.col("end_y"))
    paths = keep(_tiles(placed, settings).withColumn("image", F.concat("place", lines)).drop("place"), "references")
    if components.llm is not None:
        groups = tiles.ocr_groups(paths, "image", ("session_id",))
        answers = keep(recognition.recognize_groups(groups, components.llm, GROUP, cfg=settings.ocr, sleep=components.sleep, load=images.read_raw), "answers")
        parsed = parse_ocr(answers.withColumn("response", F.coalesce("response", F.lit(""))))
        ok = lambda c: F.when(F.col("success"), F.col(c)).alias(c)
        out.append(parsed.select(*GROUP, "engine", "success", "error", ok("extracted_text"), ok("note"), "response", "processed_images", none.cast("double").alias("average_confidence")))
    if components.document_ai is not None:
        read = keep(recognition.recognize_images(paths, components.document_ai, "image", GROUP, settings.ocr, components.sleep, load=images.read_raw), "read")
        place = F.when(F.col("image_type") == "original", -1).otherwise(F.col("split_index"))
        fan = recognition.document_ai_group(read.withColumn("place", place), GROUP, "place")
        out.append(fan.select(*GROUP, F.lit("document_ai").alias("engine"), "success", none.cast("string").alias("error"), F.when(F.col("success"), F.col("combined_text")).alias("extracted_text"), none.cast("string").alias("note"), none.cast("string").alias("response"), F.col("processed_images").cast("int").alias("processed_images"), "average_confidence"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def integrate(results: DataFrame, settings: Settings) -> DataFrame:
    """session_id, engine and the text of all groups in order; ``compat`` or unsorted files go by the key's text."""
    by_number = settings.integration.sort_files and not settings.compat
    order = [F.col("page_number"), F.col("source_mask_index")] if by_number else [F.col("group_key")]
    return integration.integrate(routing.succeeded(results), ["session_id", "engine"], order, "extracted_text", settings.integration)


def run(docs: DataFrame, components: Components, settings: Settings = Settings(), options: dict[str, bool] | None = None, store: str | None = None, last: bool = False) -> Run:
    """All stages over documents (session_id, path, content).  Errors are in the result, never raised.

    ``options`` are the three skip options.  Super resolution has no stage: the
    option is accepted and changes the setting only.  ``store`` is a folder that
    driver and executors share, by default a new one below
    ``spark.checkpoint.dir``; a second run of the same documents and settings
    with the same store reads the stages that are finished there.  With ``last``
    only the last stage's records are kept: a table goes when the stage that
    reads it is done, tiles are no table, and at most a few copies of the pixels
    are on disk at a time.
    """
    settings = apply_options(settings, options)
    out = Run(settings)
    steps = settings.steps
    keep = Store(docs.sparkSession, store, fingerprint(docs, settings, components.ready()), last)
    out.reused = keep.reused

    def stage(name: str, on: bool, make: Callable[[], DataFrame], before: DataFrame | None) -> DataFrame | None:
        if not on:
            out.skipped.append(name)
            return before
        try:
            if last and name == "tile":  # cut from its sources wherever it is read
                out.tables[name] = make()
                return out.tables[name]
            out.tables[name] = keep(make(), name)
            if last:
                keep.drop(*[x for x in keep.written if x != name], *(["pixels"] if name == "recognize" else []))
                out.tables = {name: out.tables[name]}
            return out.tables[name]
        except Exception as e:
            out.errors[name] = f"{type(e).__name__}: {e}"
            log.warning("stage %s failed, going on with what there is: %s", name, out.errors[name])
            return before

    pages = stage("render", True, lambda: render(docs, components, settings, keep), None)
    if pages is None:
        return out
    pages = stage("judge", steps.judge and components.have("distortion"), lambda: judge(pages, docs, components, settings, keep), pages)
    pages = stage("rotate", steps.rotate, lambda: rotate(pages, components, settings, keep), pages)
    # the split numbers images, so it runs even where nothing is to be cut
    sources = stage("split", True, lambda: split(pages, components if steps.split else dataclasses.replace(components, page_count=None), settings, keep), None)
    rows = stage("tile", sources is not None, lambda: tile(sources, settings), None)
    results = stage("recognize", rows is not None and steps.recognize and settings.ocr.enabled, lambda: recognize(sources, components, settings, keep, f"{keep.folder}/pixels"), None)
    stage("integrate", results is not None and steps.integrate, lambda: integrate(results, settings), None)
    return out


def failures(run_: Run) -> DataFrame | None:
    """session_id, page_number, error of pages that no later stage could use."""
    pages = run_.tables.get("render")
    return pages.filter(~F.coalesce("success", F.lit(False))).select("session_id", "page_number", "error") if pages is not None else None


def session_summary(run_: Run) -> DataFrame | None:
    """One row per session, of the same shape whatever failed: pages, failed pages, groups and characters by engine, error.

    A session without any integrated text has counts of 0 and an error.
    """
    pages = run_.tables.get("render")
    if pages is None:
        return None
    ok = F.coalesce(F.col("success"), F.lit(False))
    out = pages.groupBy("session_id").agg(F.count_if(F.col("page_number") > 0).alias("total_pages"), F.count_if(~ok).alias("failed_pages"), F.min(F.when(~ok, F.col("error"))).alias("page_error"))
    texts = run_.tables.get("integrate")
    if texts is None:
        none = {f"{e}_{x}": F.lit(0).cast("long") for e in ("llm", "document_ai") for x in ("files", "characters")}
        return out.withColumns(none).withColumns({"success": F.lit(False), "error": F.coalesce("page_error", F.lit("no text"))}).drop("page_error")
    own = integration.integration_summary(texts, keys=("session_id",)).drop("output_files", "total_errors", "success")
    out = out.join(own, "session_id", "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in own.columns if c != "session_id"}
    out = out.withColumns(counts)
    some = F.col("llm_characters") + F.col("document_ai_characters") > 0
    return out.withColumns({"success": some, "error": F.when(~some, F.coalesce("page_error", F.lit("no text")))}).drop("page_error")
