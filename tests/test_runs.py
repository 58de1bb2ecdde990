"""Runs of whole documents: calls are made once, go on where they stopped, and are few at a time."""

import json
import sys
import time
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quireflow.config import Settings, overlay
from quireflow.operators import recognition
from quireflow.plans import stand_ins, whole

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ON = overlay(Settings(), {"steps": {"judge": True, "rotate": True}, "dewarp": {"enable_strong_correction": False}})


class Counted:
    """A stand-in that leaves a file for each call, with the times at which it began and ended."""

    def __init__(self, folder, own, wait=0.0):
        self.folder, self.own, self.wait = folder, own, wait

    def __call__(self, given):
        began = time.time()
        time.sleep(self.wait)
        out = self.own(given)
        (self.folder / uuid.uuid4().hex).write_text(json.dumps([began, time.time()]))
        return out


def counted(tmp_path, **wait):
    """Components that count, and a function that gives the calls by component."""
    kinds = {"distortion": stand_ins.FirstDot, "orientation": stand_ins.FirstDot, "page_count": stand_ins.FirstDot, "llm": stand_ins.FingerprintRecognizer, "document_ai": stand_ins.FingerprintImageRecognizer}
    folders = {k: tmp_path / k for k in kinds}
    for f in folders.values():
        f.mkdir()
    make = lambda k: lambda: Counted(folders[k], kinds[k](), wait.get(k, 0.0))
    parts = whole.Components(stand_ins.FinerDocument, detector=stand_ins.UpsideDown, sleep=lambda _: None, **{k: make(k) for k in kinds})
    return parts, lambda: {k: len(list(f.iterdir())) for k, f in folders.items()}


def documents(spark, *texts):
    return spark.createDataFrame([(f"s{i}", f"s{i}.pdf", bytearray(t)) for i, t in enumerate(texts)], "session_id string, path string, content binary")


#: First dots: 70 is hardly readable, warped and a spread; 97 is upside down; 99 is plain.
TEXTS = (b"F" * 90, b"a" * 50, b"c" * 10)


def test_calls_are_made_once_without_a_store(spark, tmp_path):
    parts, calls = counted(tmp_path)
    run = whole.run(documents(spark, *TEXTS, b""), parts, ON)
    assert not run.errors and run.success and not run.reused
    first = run.result.collect()
    assert run.result.count() == len(first) == 6 and whole.session_summary(run).count() == 4
    assert {r.session_id: (r.reprocessed_at_scale, r.dewarping_applied) for r in run.tables["judge"].collect()} == {"s0": (True, True), "s1": (False, False), "s2": (False, False), "s3": (False, False)}
    groups = run.tables["split"].filter("success").count()
    assert calls() == {"distortion": 3, "orientation": 3, "page_count": 3, "llm": groups, "document_ai": run.tables["tile"].count()}
    for table in run.tables.values():
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "MapIn" not in plan and "Exchange" not in plan  # every stage is a table


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    parts, calls = counted(tmp_path)
    store = f"file://{tmp_path}/store"
    docs = documents(spark, *TEXTS)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(whole, "split", killed)
        with pytest.raises(KeyboardInterrupt):
            whole.run(docs, parts, ON, store=store)
    assert calls() == {"distortion": 3, "orientation": 3, "page_count": 0, "llm": 0, "document_ai": 0}
    run = whole.run(docs, parts, ON, store=store)
    assert not run.errors and {"render", "judged", "judge", "angles", "rotate"} <= set(run.reused) and "split" not in run.reused
    done = calls()
    assert done["distortion"] == done["orientation"] == done["page_count"] == 3
    rows = sorted(map(tuple, run.result.collect()))
    again = whole.run(docs, parts, ON, store=store)
    assert calls() == done and "integrate" in again.reused and sorted(map(tuple, again.result.collect())) == rows
    (tmp_path / "store/tile/_SUCCESS").unlink()  # other documents: nothing of the first is used
    other = whole.run(documents(spark, b"c" * 30), parts, ON, store=store)
    assert not other.reused and other.result.count() == 2 and calls()["distortion"] == 4


def test_few_groups_at_once_and_only_keys_travel(spark, tmp_path):
    parts, calls = counted(tmp_path, llm=0.15)
    groups = spark.range(24).select(F.col("id").alias("k"), F.array(F.struct(F.concat(F.lit("ref"), F.col("id")).alias("image"))).alias("images")).repartition(12)
    load = lambda ref: {"data": f"pixels of {ref}".encode()}
    out = recognition.recognize_groups(groups, parts.llm, ["k"], load=load)
    assert all(r.success and r.processed_images == 1 for r in out.collect()) and calls()["llm"] == 24
    events = sorted(x for f in (tmp_path / "llm").iterdir() for x in zip(json.loads(f.read_text()), (1, -1), strict=True))
    most = at = 0
    for _, step in events:
        at += step
        most = max(most, at)
    assert most == 3
    assert "binary" not in str(groups.schema.simpleString())
    failing = recognition.recognize_groups(groups.limit(1), parts.llm, ["k"], sleep=lambda _: None, load=lambda _: 1 / 0).first()
    assert not failing.success and "ZeroDivisionError" in failing.error and failing.calls == 4
    missing = spark.createDataFrame([(1, "original", None, None)], "k int, image_type string, split_index int, image string")
    row = recognition.recognize_images(missing, parts.document_ai, "image", ["k"]).first()
    assert (row.success, row.error, calls()["document_ai"]) == (False, "missing image", 0)


def test_the_last_stage_alone_leaves_no_pixels(spark, tmp_path, monkeypatch):
    whole_run = whole.run(documents(spark, *TEXTS, b"d" * 25_000), counted(tmp_path)[0], ON)
    (tmp_path / "other").mkdir()
    parts, calls = counted(tmp_path / "other")
    seen, call = [], whole.Store.__call__

    def noted(store, df, name):
        out = call(store, df, name)
        seen.append(sorted(p.name for p in store_path(store).iterdir() if list(p.glob("*.parquet"))))
        return out

    store_path = lambda s: tmp_path.__class__(s.folder.removeprefix("file://"))
    monkeypatch.setattr(whole.Store, "__call__", noted)
    stores, init = [], whole.Store.__init__
    monkeypatch.setattr(whole.Store, "__init__", lambda self, *a: (init(self, *a), stores.append(self))[0])
    run = whole.run(documents(spark, *TEXTS, b"d" * 25_000), parts, ON, last=True)
    assert run.success and not run.errors and list(run.tables) == ["integrate"]
    assert sorted(map(tuple, run.result.collect())) == sorted(map(tuple, whole_run.result.collect()))
    pixels = {"render", "judged", "rerendered", "refined", "judge", "angles", "rotate", "counted", "split"}
    assert max(len(pixels & set(x)) for x in seen) <= 4 and "tile" not in {n for x in seen for n in x}
    assert {p.name for p in store_path(stores[0]).iterdir()} == {"integrate", "finished"}
    assert calls()["llm"] > 0 and whole.failures(run) is None
    with pytest.raises(ValueError, match="named store"):
        whole.run(documents(spark, *TEXTS), parts, ON, store=f"file://{tmp_path}/s", last=True)
