"""Whole documents: stages, flags, failures, paid calls, files written and read again."""

import json
import logging
import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quireflow.config import Ocr, Settings, full_prompt, overlay
from quireflow.functions import coerce, geometry
from quireflow.operators import images, integration, judgments, recognition, routing, summaries
from quireflow.plans import stages, stand_ins, whole
from quireflow.sinks import outputs
from quireflow.sources import scans, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ON = overlay(Settings(), {"steps": {"judge": True, "rotate": True}})


class Distortion:
    """Every page is warped and hardly readable."""

    def __call__(self, image):
        return json.dumps({"needs_dewarping": 1, "readability_issues": "MAJOR"})


class LongerWhenFine(stand_ins.TextDocument):
    """A page drawn at a high resolution has one line more."""

    def render(self, index, dpi):
        w, h, data = super().render(index, dpi)
        return (w, h + 1, data + b"#" * w) if dpi >= 600 else (w, h, data)

    def page_size(self, index):
        return 595.0, 842.0


class Broken:
    def __call__(self, *_):
        raise RuntimeError("out of order")


def documents(spark, *contents):
    rows = [(f"s{i}", f"s{i}.pdf", bytearray(c)) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "session_id string, path string, content binary")


def components(**more):
    own = {"opener": stand_ins.TextDocument, "llm": stand_ins.FingerprintRecognizer, "document_ai": stand_ins.FingerprintImageRecognizer, "sleep": lambda _: None}
    return whole.Components(**(own | more))


def test_each_stage_does_its_part(spark):
    docs = documents(spark, b"a" * 5000, b"b" * 400, b"")
    run = whole.run(docs, components(orientation=stand_ins.FirstDot, page_count=stand_ins.FirstDot), ON)
    assert run.success and run.final_stage == "integrate" and run.skipped == ["judge"] and not run.errors
    assert [r.error for r in whole.failures(run).collect()] == ["ValueError: no pages"]
    turned = {r.session_id: (r.angle, r.rotated_count) for r in run.tables["rotate"].collect()}
    assert turned["s0"] == (180, 1) and turned["s1"] == (0, 0)  # a is 97, b is 98
    sides = {(r.session_id, r.source_mask_index): (r.side, r.image.width) for r in run.tables["split"].filter("success").collect()}
    assert sides == {("s0", 0): ("whole", 40), ("s1", 0): ("left", 22), ("s1", 1): ("right", 22)}
    assert run.tables["tile"].filter("session_id = 's0'").count() == 2 and run.tables["tile"].filter("session_id = 's1'").count() == 4
    got = {(r.session_id, r.engine): r.files_count for r in run.result.collect()}
    assert got == {("s0", "llm"): 1, ("s0", "document_ai"): 1, ("s1", "llm"): 2, ("s1", "document_ai"): 2}
    sessions = {r.session_id: (r.total_pages, r.failed_pages, r.llm_files, r.success, r.error) for r in whole.session_summary(run).collect()}
    assert sessions == {"s0": (1, 0, 1, True, None), "s1": (1, 0, 2, True, None), "s2": (0, 1, 0, False, "ValueError: no pages")}
    assert run.stats()["stages"] == ["render", "rotate", "split", "tile", "recognize", "integrate"]


def test_options_and_flags_change_the_result(spark):
    docs = documents(spark, b"b" * 400)
    judged = {"opener": LongerWhenFine, "distortion": Distortion, "detector": lambda: images.bright_box(90), "page_count": stand_ins.FirstDot}
    full = whole.run(docs, components(**judged), ON)
    page = full.tables["judge"].first()
    assert (page.reprocessed_at_scale, page.dewarping_applied, page.used_dpi, page.image.height) == (True, True, 436, 10)
    plain = whole.run(docs, components(**judged), ON, {"skip_dewarping": True})
    assert plain.tables["judge"].first().dewarping_applied is False
    silent = whole.run(docs, components(**judged), ON, {"skip_ocr": True})
    assert silent.final_stage == "tile" and silent.skipped == ["recognize", "integrate"]
    fine = whole.run(docs, components(**judged), ON, {"skip_super_resolution": True})
    assert fine.stats()["settings"]["super_resolution"] == {"enabled": False}
    uncut = whole.run(docs, components(**judged), overlay(ON, {"steps": {"split": False}}))
    assert (full.tables["split"].count(), uncut.tables["split"].count()) == (2, 1)
    off = whole.run(docs, components(**judged), Settings())
    assert off.skipped == ["judge", "rotate"] and "judge" not in off.tables
    unturned = whole.run(documents(spark, b"a" * 400), components(orientation=stand_ins.FirstDot), overlay(ON, {"orientation": {"enabled": False}}))
    assert unturned.tables["rotate"].first().angle == 0
    assert components(**judged).ready() == {"opener": True, "decoder": False, "distortion": True, "orientation": False, "page_count": True, "detector": True, "llm": True, "document_ai": True, "sleep": True}


def test_failures_go_on(spark, tmp_path):
    docs = documents(spark, b"a" * 400)
    run = whole.run(docs, components(llm=lambda: Broken(), orientation=lambda: Broken(), page_count=lambda: Broken()), ON, store=f"file://{tmp_path}/x")
    rows = {r.engine: r for r in run.tables["recognize"].collect()}
    assert not rows["llm"].success and "out of order" in rows["llm"].error and rows["document_ai"].success
    assert run.tables["rotate"].first().angle == 0 and run.tables["split"].count() == 1
    assert {r.engine for r in run.result.collect()} == {"document_ai"}
    nobody = whole.run(docs, components(llm=None, document_ai=None))
    assert whole.session_summary(nobody).columns == whole.session_summary(run).columns and not whole.session_summary(nobody).first().success
    assert nobody.final_stage == "tile" and "no recognizer" in nobody.errors["recognize"]
    nothing = whole.run(docs, components(opener=None), store=f"file://{tmp_path}/y")
    assert not nothing.tables["render"].first().success or not nothing.success
    assert whole.run(docs.limit(0), components(), ON).result.count() == 0


class Counting:
    """Writes a line for every call."""

    def __init__(self, path):
        self.path = path

    def __call__(self, given):
        with open(self.path, "a") as f:
            f.write("call\n")
        return '{"other": 1}' if isinstance(given, list) else ("text", 0.5)


def test_paid_calls_are_made_once(spark, tmp_path):
    pages = spark.createDataFrame([("s", 1, 1, 100, 90, "one"), ("s", 2, 1, 100, 90, "two")], "session_id string, page_number int, page_count int, width int, height int, image_path string")
    llm, single = str(tmp_path / "llm"), str(tmp_path / "single")
    engines = stages.Engines(lambda: Counting(llm), lambda: Counting(single), lambda _: None)
    calls = lambda path: len(open(path).readlines())
    out = stages.process_pages(pages, engines, store=f"file://{tmp_path}/answers")
    out.collect()
    out.count()
    assert (calls(llm), calls(single)) == (2, 4)
    again = stages.Engines(lambda: Counting(llm + "2"), lambda: Counting(single + "2"), lambda _: None)
    assert len(stages.process_pages(pages, again).collect()) == 2
    assert (calls(llm + "2"), calls(single + "2")) == (2, 4)  # without a store, once for each use
    answers = recognition.orientation_angles(spark.createDataFrame([(1, None), (2, "x")], "k int, image string"), lambda: Broken(), "image", ["k"])
    assert {r.k: (r.success, r.angle, r.error) for r in answers.collect()}[1] == (False, 0, "missing image")


def test_results_are_files_that_can_be_read(spark, tmp_path):
    run = whole.run(documents(spark, b"a" * 12_000, b"b" * 400), components(page_count=stand_ins.FirstDot), ON, store=f"file://{tmp_path}/run")
    results = run.tables["recognize"]
    folder = f"file://{tmp_path}/files"
    llm, dai = (results.filter(F.col("engine") == e) for e in ("llm", "document_ai"))
    body = outputs.result_json(Ocr(), {"group_info": outputs.group_info()})
    assert outputs.write_result_files(llm, folder, "llm", body) == {"txt": None, "json": None}
    read = spark.read.parquet(f"file://{tmp_path}/run/read")
    own = recognition.document_ai_group(read.withColumn("place", F.col("split_index")), whole.GROUP, "place").join(recognition.individual_results(read, whole.GROUP), whole.GROUP)
    own = own.withColumn("extracted_text", F.col("combined_text"))
    assert outputs.write_result_files(own, folder, "document_ai", outputs.document_ai_json()) == {"txt": None, "json": None}
    names = sorted(str(p.relative_to(tmp_path / "files")) for p in (tmp_path / "files").rglob("*.*"))
    assert "s0/page_002_mask1_ocr_result.txt" in names and "s1/page_001_mask2_documentai_result.json" in names and len(names) == 16 and not any(".part" in n for n in names)
    individual = json.loads((tmp_path / "files/s0/page_001_mask1_documentai_result.json").read_text())
    assert [x["image_type"] for x in individual["individual_results"]] == ["original", "split", "split"] and individual["document_ai_result"]["processed_images"] == 3
    assert json.loads((tmp_path / "files/s0/page_001_mask1_ocr_result.json").read_text())["group_info"]["page_number"] == 1
    few = outputs.document_ai_json(Ocr(include_individual_results=False))
    assert "individual_results" not in json.loads(own.select(few).first()[0])
    for session in ("s0", "s1"):
        parts = texts.text_parts(spark, f"{folder}/{session}")
        joined = {r.engine: r.integrated_text for r in integration.integrate(parts, ["engine"], [texts.numeric_order(F.col("filename"))]).collect()}
        assert joined == {r.engine: r.integrated_text for r in run.result.filter(F.col("session_id") == session).collect()}
    assert outputs.write_files(outputs.integrated_files(run.result), folder) == {}
    assert (tmp_path / "files/s1/llm_integrated_s1.txt").read_text() == run.result.filter("session_id = 's1' and engine = 'llm'").first().integrated_text
    judged = spark.read.parquet(f"file://{tmp_path}/run/counted").withColumn("image_idx", F.lit(0))
    assert outputs.write_files(outputs.judgment_files(judged, "page_count"), folder) == {}
    assert json.loads((tmp_path / "files/s1/page_001_page_count.json").read_text())["page_count"] == 2.0
    (tmp_path / "blocked").write_text("a file")
    assert outputs.write_result_files(llm, f"file://{tmp_path}/blocked", "llm", body)["txt"].startswith("OSError")


def test_images_are_files(spark, tmp_path):
    run = whole.run(documents(spark, b"abcd" * 100), components())
    name = F.format_string("%s/page_%03d_mask%d/split_%d.pgm", "session_id", "page_number", F.col("source_mask_index") + 1, "split_index")
    files = outputs.image_files(run.tables["tile"], name, lambda: outputs.netpbm)
    assert outputs.write_files(files, str(tmp_path)) == {}
    assert (tmp_path / "s0/page_001_mask1/split_0.pgm").read_bytes() == b"P5 40 10 255\n" + b"abcd" * 100
    try:
        outputs.jpeg()
    except ModuleNotFoundError:
        pass
    assert outputs.netpbm(np.array([[[1, 2, 3]]], np.uint8)) == b"P6 1 1 255\n\x03\x02\x01"


def test_json_types(spark):
    rows = [('{"b": 1, "i": 2.7, "d": 3}',), ('{"b": "yes", "i": "2", "d": "0.5"}',), ('{"b": true, "i": true, "d": false}',), ('{"b": 0, "i": "2.7", "d": "x"}',), ("{}",), ('{"b": null, "i": null, "d": null}',), ("no json",), (None,), ('{"b": -2.5, "i": -1.9, "d": 1e3}',)]
    field = lambda k: coerce.JsonField(F.col("p"), k)
    got = spark.createDataFrame(rows, "p string").select(field("b").boolean(coerce.judge_bool), field("b").boolean(coerce.to_bool), field("i").integer(coerce.judge_int), field("d").double(coerce.judge_double)).collect()
    assert [tuple(r) for r in got] == [(True, True, 2, 3.0), (True, False, 2, 0.5), (True, True, 1, 0.0), (False, False, None, None), (False, False, None, None), (False, False, None, None), (False, False, None, None), (False, False, None, None), (True, True, -1, 1000.0)]
    ties = [0.0625, 0.1875, 0.5, 0.3125, 0.12345, 2.675, -0.0625]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in ties], "x double").select(coerce.round_mean(F.col("x"))).collect()] == [round(x, 3) for x in ties]
    columns = spark.createDataFrame([('{"needs_dewarping": 1, "page_count": 2.7}',)], "p string").select(*judgments.summary_columns(F.col("p"))).first()
    assert (columns.needs_dewarping, columns.page_count) == (True, 2)


def test_documents_are_opened_once(spark, tmp_path):
    path = str(tmp_path / "opened")

    class Noted(stand_ins.TextDocument):
        def __init__(self, content):
            with open(path, "a") as f:
                f.write("open\n")
            super().__init__(content)

    docs = documents(spark, b"x" * 35_000)
    pages = docs.select("path", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("page_number")).withColumn("dpi", F.lit(100))
    out = {r.page_number: r for r in scans.render_pages(docs, pages, Noted).collect()}
    assert [out[k].success for k in range(1, 6)] == [True, True, True, True, False] and len(open(path).readlines()) == 1
    meta = scans.document_metadata(docs, stand_ins.TextDocument).first()
    assert meta.metadata == {"pages": "4", "bytes": "35000"} and not scans.document_metadata(docs, lambda _: 1 / 0).first().success


def test_logging(tmp_path):
    log = whole.set_up_logging("debug", str(tmp_path / "run.log"))
    n = len(log.handlers)
    assert log.level == 10 and whole.set_up_logging("nonsense", str(tmp_path / "run.log")).level == 20 and len(log.handlers) == n
    log.warning("seen")
    assert logging.getLogger("py4j").level == logging.WARNING and not components(llm=None).have("opener", "llm")
    assert "! " in (tmp_path / "run.log").read_text() and "WARNING quireflow: seen" in (tmp_path / "run.log").read_text()


@pytest.mark.parametrize("angle", [0, 90, -90, 180])
def test_image_columns_keep_nulls(spark, angle):
    df = spark.createDataFrame([(1, None, angle)], "k int, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>, angle int")
    row = images.rotate_images(df).first()
    assert row.image is None and row.error is None


def png(width, height, data):
    """A grey PNG of these bytes."""
    part = lambda kind, body: len(body).to_bytes(4, "big") + kind + body + zlib.crc32(kind + body).to_bytes(4, "big")
    head = width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
    lines = b"".join(b"\0" + data[at : at + width] for at in range(0, len(data), width))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def test_image_files_are_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.png").write_bytes(png(3, 2, bytes(range(6))))
    (tmp_path / "in/b.png").write_bytes(b"no image")
    own = {r.path[-5:]: r for r in scans.images(spark, str(tmp_path / "in")).collect()}
    assert own["a.png"].success and not own["b.png"].success and bytes(own["a.png"].image.data) == bytes(range(6))
    info = {r.path[-5:]: r for r in scans.image_info(spark, str(tmp_path / "in")).collect()}
    assert (info["a.png"].width, info["a.png"].height, info["a.png"].nChannels) == (3, 2, 1) and info["b.png"].length == 8
    files = spark.read.format("binaryFile").load(str(tmp_path / "in/b.png"))
    assert scans.encoded(files).first().base64 == "bm8gaW1hZ2U="


def test_helpers(spark):
    assert full_prompt({"system": "a", "user": "b"}) == "a\n\nb" and full_prompt({}) == "\n\n"
    slope = spark.range(1).select(*(geometry.contour_slope(F.lit(10.0), F.lit(21.0), F.lit(r)) for r in (0.0, 0.5, 1.0))).first()
    assert slope[0] == slope[2] == 0.0 and abs(slope[1] - (15.0 * 0.5 * 0.5 + 16.0 * 0.5 * 0.5)) < 1e-9
    shape = spark.createDataFrame([(None, True), (0, True), (2, False), (2, True)], "n int, ok boolean").select(routing.document_failure(F.col("n"), F.col("ok"))).collect()
    counts = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert summaries.as_map(summaries.histogram(counts, F.col("v"), "none")).first().distribution == {"a": 1, "b": 2, "none": 1}
    assert summaries.render_totals(counts.selectExpr("true success", "1 used_dpi", "2L file_size_bytes").limit(0)).first().average_dpi == 0.0
    assert [r[0] for r in shape] == ["unreadable", "no pages", "first page does not load", None]
