"""Operators on small tables, with failures, nulls and empty inputs."""

import json
import os
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quireflow.config import Dewarp, Integration, Ocr, Settings, apply_options, load_env, load_prompts, load_settings, overlay
from quireflow.operators import images, integration, judgments, recognition, routing, summaries, tiles
from quireflow.plans import stages
from quireflow.sinks import outputs
from quireflow.sources import scans, texts
from quireflow.streaming import watch

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this module

JUDGED = "page int, o int, success boolean, has_table_elements string, has_handwritten_notes_or_marks string, page_count string, page_count_confidence string, confidence_score string, readability_issues string, readability_comment string, overall_comment string"


def test_merge(spark):
    rows = [
        (1, 1, True, "True", "False", "1", ".9", ".8", "none", None, None),
        (2, 1, True, "False", "False", "1", ".9", ".8", "minor", None, "a"),
        (2, 2, True, "True", "False", "1", ".8", ".6", "MAJOR", None, "b"),
        (3, 1, False, "True", "True", "2", "1", "1", "major", None, "x"),
        (3, 2, True, "False", "True", "2", None, ".5", "weird", None, "c"),
        (4, 1, True, None, None, "2", None, None, None, None, None),
        (4, 2, True, None, None, "2", None, None, None, None, None),
        (5, 1, True, None, None, "x", None, None, None, None, None),
        (5, 2, False, None, None, "3", None, None, None, None, None),
        (6, 1, False, "True", "True", "3", "1", "1", "major", "r", "x"),
    ]
    got = {r.page: r for r in judgments.merge_judgments(spark.createDataFrame(rows, JUDGED), ["page"], "o").collect()}
    short = {p: (r.has_table_elements, r.has_handwritten_notes_or_marks, r.page_count, r.page_count_confidence, r.confidence_score, r.readability_issues, r.overall_comment) for p, r in got.items()}
    assert short == {
        1: (True, False, 1, 0.9, 0.8, "none", None),
        2: (True, False, 2, 0.85, 0.7, "major", "img1: a\nimg2: b"),
        3: (False, True, 2, None, 0.5, "none", "img2: c"),
        4: (False, False, 3, None, None, "none", None),
        5: (False, False, 1, None, None, "none", None),
        6: (False, False, 1, None, None, "none", None),
    }
    assert all(r.success for r in got.values())


@pytest.mark.parametrize("parts,with_,without", [([], "", ""), (["a"], "a", "a"), (["a", "b"], "a\n\n\nb", "a\nb"), (["", "b"], "\n\nb", "b"), (["a", None, "c"], "a\n\n\nc", "a\nc")])
def test_join_parts(spark, parts, with_, without):
    df = spark.createDataFrame([(parts,)], "p array<string>")
    assert df.select(integration.join_parts(F.col("p"))).first()[0] == with_
    assert df.select(integration.join_parts(F.col("p"), Integration(include_separators=False))).first()[0] == without


def test_integration_drops_blank_parts_and_orders(spark):
    df = spark.createDataFrame([("s", 10, "ten"), ("s", 2, " two\n"), ("s", 3, "　"), ("e", 1, "  ")], "k string, o int, text string")
    got = [(r.k, r.files_count, r.integrated_text, r.total_characters) for r in integration.integrate(df, ["k"], [F.col("o")]).collect()]
    assert got == [("s", 2, "two\n\n\nten", 9)]
    assert integration.integrate(df.limit(0), ["k"], [F.col("o")]).count() == 0


def test_drop_overlap(spark):
    df = spark.createDataFrame([("s", 1, "one two three four"), ("s", 2, "three four five"), ("s", 3, "else")], "k string, o int, text string")
    assert [r.text for r in integration.drop_overlap(df, ["k"], "o").orderBy("o").collect()] == ["one two three four", " five", "else"]


def test_tiles_and_groups(spark):
    src = spark.createDataFrame([(1, 0, 1000, "a"), (1, 1, 420, "b"), (1000, 0, 50, "c")], "page_number int, source_mask_index int, h int, image_path string")
    own = tiles.tile_records(src, F.col("h"))
    assert own.count() == 6 + 5 + 2
    groups = {r.group_key: r for r in tiles.ocr_groups(own).collect()}
    assert set(groups) == {"page_001_mask1", "page_001_mask2", "page_1000_mask1"}
    assert [x.split_index for x in groups["page_001_mask1"].images] == [0, 1, 2, 3, 4, 5]
    summary = tiles.tiling_summary(own).first()
    assert (summary.total_pages, summary.total_split_images, summary.total_source_images, summary.average_splits_per_page) == (2, 10, 3, 5.0)
    assert tiles.tiling_summary(own.limit(0)).first().average_splits_per_page == 0.0
    assert [r[0] for r in tiles.tiles_of_type(own, "original").collect()] == ["a", "b", "c"]


def test_routing(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, success boolean")
    ok, bad = routing.split_by_success(df)
    assert (ok.count(), bad.count()) == (1, 2)
    one = spark.range(1)
    arr = lambda *x: F.array(*map(F.lit, x))
    row = one.select(
        routing.should_split(F.lit(2), F.lit(None), arr("a")), routing.should_split(F.lit(2), F.lit(True), arr("a")), routing.should_split(F.lit(2), F.lit(False), arr("a", "b")),
        routing.needs_dewarp(F.lit(True), F.lit("False")), routing.needs_dewarp(F.lit(True), F.lit("False"), compat=True),
        F.size(routing.pair_arrays(arr(1, 2), arr(3))), F.size(routing.pair_arrays(arr(1, 2), arr(3, 4))), routing.final_stage(F.lit(True), F.lit(True), F.lit(False)),
        routing.images_of(F.lit(None).cast("array<string>"), F.lit("one")), routing.image_failure(F.lit(True), F.lit(200), F.lit(None).cast("int"), F.lit(5000)),
    ).first()
    assert tuple(row) == (True, False, False, False, True, 0, 2, 2, ["one"], "too small")


def test_summaries_of_nothing(spark):
    empty = spark.createDataFrame([], "success boolean, file_size_bytes long, scale_factor double, skipped boolean, angle int, extracted_text string, processed_images int")
    assert summaries.rerender_summary(empty).first().average_scale_factor == 0.0
    assert summaries.dewarp_summary(empty).first().skip_rate == 0.0
    assert summaries.rotation_summary(empty).first().rotation_rate == 0.0
    assert summaries.ocr_summary(empty).first().average_text_length == 0.0
    assert summaries.render_summary(empty).first().success is False


def test_turning_kernels():
    px = np.arange(6, dtype=np.uint8).reshape(2, 3, 1)
    assert images.turn(px, 90)[:, :, 0].tolist() == [[3, 0], [4, 1], [5, 2]]
    assert (images.turn(images.turn(px, 90), -90) == px).all()
    assert (images.turn(px, 90, compat=True) == images.turn(px, -90)).all()
    assert (images.turn(px, 180) == px[::-1, ::-1]).all()
    assert images.turn(np.zeros((10, 20, 3), np.uint8), 45).shape[0] == int(10 * 2**-0.5 + 20 * 2**-0.5)


def test_dewarp_kernels():
    px = np.full((40, 60, 3), 10, np.uint8)
    px[5:31, 8:51] = 200
    out, skipped = images.dewarp(px, images.bright_box())
    assert not skipped and out.min() >= 190  # the page fills the picture
    same, skipped = images.dewarp(np.zeros((5, 5, 3), np.uint8), images.bright_box())
    assert skipped and same.shape == (5, 5, 3)
    x, y = images.dewarp_maps((11, 12), np.array([[0, 4], [11, 4], [11, 8], [0, 8]], float), compat=True)
    slow = np.array([[j + sum(s * w for s, w in ((images.edge_shift(np.array([[0, 4], [11, 4], [11, 8], [0, 8]], float), 12, 12)[k][i], v) for k, v in ((0, 1 - j / 10), (1, j / 10)))) * 0.03 for i in range(12)] for j in range(11)])
    assert np.allclose(y, slow) and (x[0] == np.arange(12)).all()
    assert images.dewarp(px, images.bright_box(), Dewarp(crop_margin_px=2))[0].shape == (36, 56, 3)
    assert (images.mark_centre(px) != px).any()


def test_image_columns(spark):
    data = bytes(range(24))
    df = spark.createDataFrame([(1, 90, ("o", 4, 6, 1, 0, data)), (2, 0, ("o", 4, 6, 1, 0, data)), (3, 90, ("o", 4, 6, 1, 0, b"x"))], "id int, angle int, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    got = {r.id: r for r in images.rotate_images(df).collect()}
    assert (got[1].image.height, got[1].image.width) == (6, 4) and got[1].error is None
    assert got[2].image.data == data and got[3].error.startswith("ValueError")
    cut = df.filter("id = 1").select(images.slice_rows(F.col("image"), F.lit(1), F.lit(3)).alias("s")).first().s
    assert bytes(cut.data) == data[6:18] and cut.height == 2


def test_retries():
    slept, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("no")
        return "yes"

    assert recognition.with_backoff(flaky, Ocr(), slept.append) == ("yes", None, 3) and slept == [1.0, 2.0]
    slept.clear()
    result, error, n = recognition.with_backoff(lambda: 1 / 0, Ocr(), slept.append)
    assert (result, n, slept) == (None, 4, [1.0, 2.0, 4.0]) and "ZeroDivisionError" in error

    def closed():
        raise recognition.Unavailable("not set up")

    assert recognition.with_backoff(closed, Ocr(), slept.append)[1:] == ("not set up", 1)
    answers = iter(["junk", "[]", '{"a": 1}'])
    got = recognition.judge_once(lambda _: next(answers), None)
    assert got["success"] and got["attempt"] == 3
    assert recognition.judge_once(lambda _: "junk", None)["success"] is False


def _no_sleep(_):
    return None


class AngleJudge:
    def __call__(self, image):
        return json.dumps({"recommended_angle": int(image)})


def test_recognition(spark):
    pages = spark.createDataFrame([("s", 1, 1, 500, 100, "one"), ("s", 2, 2, 500, 100, "two"), ("s", 3, 1, 500, 100, "<fail>")], "session_id string, page_number int, page_count int, width int, height int, image_path string")
    engines = stages.Engines(sleep=_no_sleep)
    got = {r.engine: r for r in stages.process_pages(pages, engines).collect()}
    assert got["llm"].files_count == 3 and got["document_ai"].files_count == 3
    assert got["llm"].integrated_text.split("\n\n\n") == ["one\none", "two\ntwo", "two\ntwo"]
    keys = ["page"]
    imgs = spark.createDataFrame([(1, "90"), (2, None), (3, "10")], "page int, image string")
    angles = {r.page: (r.success, r.angle) for r in recognition.orientation_angles(imgs, AngleJudge, "image", keys).collect()}
    assert angles == {1: (True, 90), 2: (False, 0), 3: (True, 0)}
    assert {r.angle for r in recognition.orientation_angles(imgs, None, "image", keys).collect()} == {0}


def test_settings(tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(json.dumps({"tiling": {"num_splits": 3}, "compat": True}))
    got = load_settings(str(path), {"skip_dewarping": True, "skip_ocr": True, "skip_super_resolution": True})
    assert (got.tiling.num_splits, got.tiling.overlap_ratio, got.compat, got.dewarp.enabled, got.ocr.enabled, got.steps.recognize, got.super_resolution.enabled) == (3, 0.1, True, False, False, False, False)
    assert apply_options(Settings(), None) == Settings()
    with pytest.raises(KeyError):
        overlay(Settings(), {"nothing": 1})
    (tmp_path / "prompts.json").write_text(json.dumps({"p": {"system": "a", "user": "b"}}))
    assert load_prompts(str(path))["p"]["user"] == "b"
    env = tmp_path / ".env"
    env.write_text("# note\nQUIREFLOW_TEST_KEY='v'\n")
    assert load_env(str(env)) == {"QUIREFLOW_TEST_KEY": "v"} and os.environ["QUIREFLOW_TEST_KEY"] == "v"
    assert load_env(str(tmp_path / "none")) == {}


class FakeDocument:
    """A document of lines "width height"; rendering gives a byte per dot."""

    def __init__(self, content):
        self.sizes = [tuple(map(float, x.split())) for x in content.decode().split("\n") if x]

    def page_count(self):
        return len(self.sizes)

    def page_size(self, k):
        return self.sizes[k]

    def metadata(self):
        return {}

    def render(self, k, dpi):
        return int(self.sizes[k][0] * dpi / 72), 1, b"x"

    def close(self):
        pass


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/b.PDF").write_text("595 842\n612 792\n")
    (tmp_path / "in/a.pdf").write_text("\n")
    (tmp_path / "in/c.txt").write_text("no")
    docs = scans.documents(spark, str(tmp_path / "in"))
    assert scans.first_document(docs).first().path.endswith("a.pdf")
    rows = scans.pages(docs, FakeDocument)
    assert {(r.success, r.page_number) for r in rows.collect()} == {(False, None), (True, 1), (True, 2)}
    info = {r.valid: r for r in scans.document_info(docs, FakeDocument).collect()}
    assert info[True].suggested_dpi == 218 and "no pages" in info[False].error
    out = scans.render_pages(docs, rows.filter("success").withColumn("dpi", F.lit(144)), FakeDocument).orderBy("page_number").collect()
    assert [(r.output_path, r.width, r.zoom_factor) for r in out] == [("b_page_001.jpg", 1190, 2.0), ("b_page_002.jpg", 1224, 2.0)]
    states = rows.filter("success").withColumns({"used_dpi": F.lit(218), "readability_issues": F.when(F.col("page_number") == 2, "Major").otherwise("none")})
    assert [r.used_dpi for r in scans.rerender(docs, states, FakeDocument).collect()] == [436]


def test_text_files(spark, tmp_path):
    for name, text in {"page_1000_mask1_ocr_result.txt": "z", "page_999_mask10_ocr_result.txt": " y ", "page_999_mask2_ocr_result.txt": "x", "p_ocr_result.txt": " ", "page_001_mask1_documentai_result.txt": "d"}.items():
        (tmp_path / name).write_text(text)
    parts = texts.text_parts(spark, str(tmp_path))
    got = {r.engine: r for r in integration.integrate(parts, ["engine"], [texts.numeric_order(F.col("filename"))]).collect()}
    assert got["llm"].integrated_text == "x\n\n\ny\n\n\nz" and got["document_ai"].files_count == 1


def test_sinks_and_stream(spark, tmp_path):
    df = spark.createDataFrame([("s", "llm", True, "text", "g", 1, "ok", "raw", 4), ("t", "llm", False, None, "h", 1, "not_json", "raw", 0)], "session_id string, engine string, success boolean, extracted_text string, group_key string, processed_images int, note string, response string, total_characters int")
    assert outputs.write_results(df, str(tmp_path / "out"), outputs.result_json()) == {"txt": None, "json": None}
    body = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/json")).collect()]
    assert {b["success"] for b in body} == {True, False} and any(b.get("processing_notes") == ["not_json"] for b in body)
    outputs.write_integrated(df.withColumn("integrated_text", F.col("extracted_text")), str(tmp_path / "joined"))
    assert spark.read.text(str(tmp_path / "joined")).count() == 1
    assert "Error" in outputs.run_sinks({"bad": lambda: 1 / 0, "good": lambda: None})["bad"]
    outputs.write_summary(df.groupBy().count(), str(tmp_path / "sum"), "s", "llm")
    assert spark.read.json(str(tmp_path / "sum")).first().session_id == "s"
    (tmp_path / "watched").mkdir()
    (tmp_path / "watched/a.bin").write_bytes(b"abc")
    stream = watch.watch_files(spark, str(tmp_path / "watched"))
    for _ in range(2):  # a restart finds nothing new
        watch.run_batches(stream, lambda x: x.select("path", "length"), str(tmp_path / "seen"), str(tmp_path / "cp")).awaitTermination(60)
    assert [r.length for r in spark.read.parquet(str(tmp_path / "seen")).collect()] == [3]
