"""Named files listed, read and moved by tasks, against Spark's readers and with the driver out of it."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quireflow.plans import catalogue, stand_ins
from quireflow.sinks import committed, outputs
from quireflow.sources import files, pdf, scans, texts


@pytest.fixture
def folder(tmp_path):
    for name, text in {"a.pdf": "1", "b.PDF": "22", "c.txt": "no", "s1/e b%20.pdf": "3", "s1/t/u/deep.pdf": "", "_hidden/x.pdf": "x", "s1/.y.pdf": "y", "_z.pdf": "z", "k=1/w.pdf": "4"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    return tmp_path


def test_documents_are_those_of_sparks_reader(spark, folder, monkeypatch):
    columns = ["session_id", "path", "content", "modified", "length"]
    rows = lambda: sorted(map(tuple, scans.documents(spark, f"file://{folder}").select(*columns).collect()))
    own = rows()
    with monkeypatch.context() as m:
        m.setattr(files, "listed", lambda *_: None)
        assert rows() == [r for r in own if r[-1]] and len(own) == 5  # Spark's leaves empty files out
    for kind in (os.path.join(folder, "*.pdf"), "viewfs://none/in", str(folder / "a.pdf")):
        assert files.listed(spark, kind) is None  # patterns, other file systems and single files are Spark's


def test_documents_are_not_indexed_by_the_driver(spark, folder):
    plans = [scans.documents(spark, str(folder)), texts.text_parts(spark, str(folder))]
    assert all(not p.inputFiles() and "FileScan" not in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)
    flat = files.listed(spark, str(folder), "*.pdf", deep=False)
    assert sorted(r.path.rpartition("/")[2] for r in flat.collect()) == ["a.pdf"]


def test_files_are_moved_by_tasks(spark, tmp_path):
    rows = spark.range(90).select(F.format_string("s%d/_f%d.txt", F.col("id") % 7, "id").alias("name"), F.col("id").cast("string").alias("content")).repartition(6)
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    committed.write_named(rows, f"file://{tmp_path}/out")
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before
    assert len(jobs) > 1  # the files are written, then moved
    assert {p.name: p.read_text() for p in (tmp_path / "out").rglob("*.txt")} == {f"_f{i}.txt": str(i) for i in range(90)}
    assert not list((tmp_path / "out").glob("_staging*"))
    with pytest.raises(Exception, match="(?i)directory|exists"):  # a name that can't be moved to
        (tmp_path / "out/s9/x.txt/y").mkdir(parents=True)
        committed.write_named(spark.createDataFrame([("s9/x.txt", "1")], "name string, content string"), f"file://{tmp_path}/out")
    assert not list((tmp_path / "out").glob("_staging*"))


def test_moves_go_on_after_an_attempt_that_was_lost(tmp_path):
    for name in ("a", "f/b", "f/g/c"):
        (tmp_path / "staged" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "staged" / name).write_text(name)
    (tmp_path / "out").mkdir()
    os.rename(tmp_path / "staged/a", tmp_path / "out/a")
    system, _ = committed.file_system(str(tmp_path))
    assert committed.move_all(system, f"{tmp_path}/staged", f"{tmp_path}/out") == 2
    assert not (tmp_path / "staged").exists() and committed.move_all(system, f"{tmp_path}/staged", f"{tmp_path}/out") == 0
    assert sorted(p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a", "f/b", "f/g/c"]


def test_pages_come_in_batches_of_many(spark):
    text = bytes(random.Random(4).choices(b"abc def", k=30_000))
    docs = spark.createDataFrame([(f"s{i}", f"{i}.pdf", bytearray(text), i % 5, "t", i) for i in range(10)], "session_id string, path string, content binary, kind int, title string, k int")
    own = stand_ins.as_pdfs(docs).coalesce(1)
    run = scans._rendered(pdf.PdfDocument, lambda x: x.as_py(), "content", ["session_id"])
    given = own.select("session_id", "path", "content").toArrow().combine_chunks()
    given = given.append_column("numbers", pa.array([[1, 2, 3, 9]] * 10, pa.list_(pa.int32()))).append_column("dpis", pa.array([[72] * 4] * 10, pa.list_(pa.int32())))
    batches = list(run(iter(given.to_batches())))
    rows = [r for b in batches for r in b.to_pylist()]
    assert len(batches) == 1 and len(rows) == 40 and sum(r["success"] for r in rows) == 24
    assert all(r["session_id"] == f"s{r['path'][0]}" for r in rows)
    for kind in range(4):
        assert b"".join(r["image"][:: -1 if kind == 1 else 1] for r in rows if r["path"] == f"{kind}.pdf" and r["success"]) == text


def test_pages_drawn_by_blocks_of_lines(monkeypatch):
    text = bytes(random.Random(5).choices(range(33, 127), k=9_973))
    doc = lambda: pdf.PdfDocument(stand_ins.PdfWriter(text, stand_ins.PACKED, "t").bytes())
    whole = doc().render(0, 150)
    for dots in (1, 40, 997):
        monkeypatch.setattr(pdf, "DRAWN_DOTS", dots)
        assert doc().render(0, 150) == whole
    assert whole[0] == 83 and len(np.unique(np.frombuffer(whole[2], np.uint8))) > 90


def test_pdf_files_stand_in_folders(spark, tmp_path):
    names = spark.range(500).select(catalogue._in_folders(F.format_string("doc_%d.pdf", "id")).alias("n")).collect()
    assert len({r.n.split("/")[0] for r in names}) > 200 and names[7].n.endswith("/doc_7.pdf")


def test_images_are_decoded_in_rounds(spark, tmp_path, monkeypatch):
    image = F.struct(F.lit("").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), F.encode(F.repeat(F.chr(F.col("id") + 40), 64), "utf-8").alias("data"))
    own = spark.range(60).select(F.format_string("%d/%d.jpg", F.col("id") % 6, "id").alias("name"), image.alias("image"))
    outputs.write_files(outputs.image_files(own, F.col("name"), outputs.jpeg), f"file://{tmp_path}/in")
    parts = scans.rounds(spark, str(tmp_path / "in"), 25)
    assert [len(x) for x in parts] == [2, 2, 2] and len({f for x in parts for f in x}) == 6
    seen, read = [], scans.images
    monkeypatch.setattr(scans, "rounds", lambda *_, f=scans.rounds: f(*_, 25))
    monkeypatch.setattr(scans, "images", lambda s, p: seen.append(p) or read(s, p))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    got = scans.decoded_images(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").collect()
    assert len(seen) == 4 and spark.conf.get("spark.sql.files.openCostInBytes") == cost  # three rounds and a schema
    assert {int(r.path.rpartition("/")[2][:-4]): bytes(r.image.data) for r in got} == {i: bytes([i + 40]) * 64 for i in range(60)}
    (tmp_path / "none").mkdir()
    assert scans.decoded_images(spark, str(tmp_path / "none"), str(tmp_path / "out2")).count() == 0
