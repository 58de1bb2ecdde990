"""PDF structure, page ranges, committed files, and JPEG without a library."""

import os
import random
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from quireflow.functions import jpeg
from quireflow.plans import stand_ins
from quireflow.sinks import committed, outputs
from quireflow.sources import pdf, scans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = bytes(random.Random(1).randrange(32, 127) for _ in range(25_013))


def scanned(kind, text=TEXT, title="A (title) \\ é"):
    return stand_ins.PdfWriter(text, kind, title).bytes()


@pytest.mark.parametrize("kind", [stand_ins.PLAIN, stand_ins.PACKED, stand_ins.UPDATED, stand_ins.DAMAGED])
def test_structure(kind):
    doc = pdf.PdfDocument(scanned(kind))
    assert doc.page_count() == 3 and doc.metadata()["title"] == "A (title) \\ é" and doc.metadata()["format"] == "PDF 1.7"
    assert [doc.page_size(k) for k in range(3)] == [(40, 250), (40, 250), (40, 126)]
    for k in range(3):
        part = TEXT[k * 10_000 : (k + 1) * 10_000]
        part = part.ljust(-(-len(part) // 40) * 40)
        assert doc.render(k, 72) == (40, len(part) // 40, part[::-1] if kind == stand_ins.PACKED else part)
    assert doc.render(2, 144)[:2] == (80, 252)
    with pytest.raises(IndexError):
        doc.page_size(3)


def loose(*objects, trailer=b"trailer << /Root 1 0 R /Info 9 0 R >>"):
    """A document without cross-references."""
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj %s endobj" % x for x in objects) + b"\n" + trailer


def test_pages_inherit():
    image = zlib.compress(bytes([10, 20, 30, 40, 50, 60]))
    doc = pdf.PdfDocument(
        loose(
            (1, b"<</Type/Catalog/Pages 2 0 R>>"),
            (2, b"<</Type/Pages/Kids[3 0 R 4 0 R 5 0 R]/MediaBox[0 0 200 100]/Rotate 90/Resources<</XObject<</I 7 0 R>>>>>>"),
            (3, b"<</Type/Page/CropBox[10 20 300 80]>>"),
            (4, b"<</Type/Pages/Kids[6 0 R]/Rotate -180/MediaBox 8 0 R>>"),
            (5, b"<</Type/Page/Rotate 0/MediaBox[3 2 0 0]/UserUnit 2/Contents 10 0 R>>"),
            (6, b"<</Type/Page/MediaBox[0 0 0 0]/Contents 10 0 R>>"),
            (7, b"<</Subtype/Image/Width 3/Height 2/ColorSpace/DeviceGray/BitsPerComponent 8/Filter[/FlateDecode]/Length %d>>stream\n%s\nendstream" % (len(image), image)),
            (8, b"[0 0 50 60.5]"),
            (9, b"<</Title<feff00e90021>/Author(a\\(b\\)\\051\\n(c))/Trapped/False/Custom(x)>>"),
            (10, b"<</Length 99>>stream\nq 3 0 0 2 0 0 cm BI /W 1 ID \x00(] EI /I Do Q\nendstream"),
        )
    )
    assert [doc.page_size(k) for k in range(3)] == [(60, 190), (0, 0), (6, 4)]
    assert doc.metadata() == {"format": "PDF 1.4", "title": "é!", "author": "a(b))\n(c)", "trapped": "False"}
    assert doc.render(2, 36) == (3, 2, bytes([10, 20, 30, 40, 50, 60]))
    with pytest.raises(pdf.Broken, match="without an image"):
        doc.render(0, 72)


@pytest.mark.parametrize(
    "content",
    [
        b"",
        b"hello",
        b"%PDF-1.4",
        loose((1, b"<</Type/Catalog/Pages 2 0 R>>"), (2, b"<</Kids[2 0 R]>>")),
        loose((1, b"<</Type/Catalog/Pages 2 0 R>>"), (2, b"<</Kids[7 0 R]>>")),
        loose((1, b"<</Type/Catalog/Pages 2 0 R>>"), (2, b"<</Type/Page>>"), trailer=b"trailer <</Root 1 0 R/Encrypt 3 0 R>>"),
        loose((1, b"[" * 500)),
        loose((1, b"1 0 R"), trailer=b"trailer <</Root 1 0 R>>"),
    ],
)
def test_what_is_no_document(content):
    with pytest.raises(pdf.Broken):
        pdf.PdfDocument(content)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 3), st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 255)), min_size=1, max_size=12), st.integers(0, 10**6))
def test_damage_is_an_error_or_a_document(kind, changes, cut):
    content = bytearray(scanned(kind, TEXT[:300], "t"))
    for at, byte in changes:
        content[at % len(content)] = byte
    try:
        doc = pdf.PdfDocument(bytes(content[: cut % (2 * len(content))]))
        for k in range(min(doc.page_count(), 3)):
            doc.page_size(k)
            doc.render(k, 10)
    except Exception as e:
        assert not isinstance(e, MemoryError | RecursionError | AssertionError)


@pytest.mark.parametrize("colours", [1, 3])
def test_predictors(colours):
    rng = np.random.default_rng(colours)
    pixels = rng.integers(0, 256, (5, 7 * colours), dtype=np.uint8)
    out, above = b"", np.zeros(7 * colours, int)
    for kind, line in zip([0, 1, 2, 3, 4], pixels.astype(int), strict=True):
        left, corner = np.concatenate([np.zeros(colours, int), line[:-colours]]), np.concatenate([np.zeros(colours, int), above[:-colours]])
        guess = left + above - corner
        far = np.stack([abs(guess - x) for x in (left, above, corner)])
        paeth = np.choose(far.argmin(0), [left, above, corner])
        out += bytes([kind]) + ((line - [0 * left, left, above, (left + above) // 2, paeth][kind]) & 255).astype(np.uint8).tobytes()
        above = line
    assert pdf.unpredicted(out, 15, colours, 8, 7) == pixels.tobytes()
    steps = np.diff(pixels.reshape(5, 7, colours).astype(int), axis=1, prepend=0) & 255
    assert pdf.unpredicted(steps.astype(np.uint8).tobytes(), 2, colours, 8, 7) == pixels.tobytes()


class Noted(pdf.PdfDocument):
    """Says in which task it was opened."""

    def __init__(self, content):
        super().__init__(content)
        with open(os.environ.get("NOTED") or self.metadata()["title"], "a") as f:
            f.write(f"{TaskContext.get().partitionId()}\n")


def test_a_long_document_is_shared(spark, tmp_path):
    log = str(tmp_path / "opened")
    docs = spark.createDataFrame([("s", "long.pdf", bytearray(b"x" * 10_000 * 299 + b"end"), 0, log), ("t", "one.pdf", bytearray(b"y"), 1, log), ("u", "none.pdf", bytearray(b"z"), 4, "")], "session_id string, path string, content binary, kind int, title string")
    committed.write_named(stand_ins.as_pdfs(docs).select(F.concat(F.lit("a folder/"), "path").alias("name"), "content"), f"file://{tmp_path}/in")
    files = scans.documents(spark, f"file://{tmp_path}/in")
    sized = scans.pages(files, pdf.PdfDocument)
    assert {(r.path.split("/")[-1], r.success) for r in sized.select("path", "success").distinct().collect()} == {("long.pdf", True), ("one.pdf", True), ("none.pdf", False)}
    wanted = sized.filter("success").withColumn("dpi", F.lit(72))
    wanted = wanted.unionByName(wanted.filter("path like '%one.pdf'").withColumn("page_number", F.lit(5)))
    out = {(r.path.split("/")[-1], r.page_number): r for r in scans.render_files(wanted, Noted, size=50).collect()}
    assert len(out) == 302 and all(out["long.pdf", k].success and out["long.pdf", k].height == 250 for k in range(1, 300))
    assert bytes(out["long.pdf", 300].image) == b"end" + b" " * 37 and not out["one.pdf", 5].success
    opened = open(log).read().split()
    assert len(opened) == 7 and len(set(opened)) > 1  # six ranges and one
    gone = wanted.limit(1).withColumn("path", F.lit(f"file:{tmp_path}/gone.pdf"))
    assert "FileNotFoundError" in scans.render_files(gone, pdf.PdfDocument).first().error


def below(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_files_appear_together(spark, tmp_path):
    rows = [(f"s{i % 3}/file {i}.txt", f"text {i}") for i in range(40)]
    df = spark.createDataFrame([*rows, (None, "x"), ("y", None)], "name string, content string").repartition(5)
    assert outputs.write_files(df, f"file://{tmp_path}/out") == {}
    assert below(tmp_path / "out") == {n: t.encode() for n, t in rows}
    assert outputs.write_files(df.limit(0), str(tmp_path / "none")) == {} and below(tmp_path / "none") == {}
    again = spark.createDataFrame([("s0/file 0.txt", "new"), ("z", "")], "name string, content string")
    outputs.write_files(again, str(tmp_path / "out"))
    assert below(tmp_path / "out")["s0/file 0.txt"] == b"new" and below(tmp_path / "out")["z"] == b"" and len(below(tmp_path / "out")) == 41


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    rows = [(f"{i}.txt", "x") for i in range(30)] + [("a/../../up.txt", "x")]
    with pytest.raises(OSError, match="not a name below the target"):
        outputs.write_files(spark.createDataFrame(rows, "name string, content string").repartition(4), f"file://{tmp_path}/out")
    assert below(tmp_path) == {} and not list((tmp_path / "out").glob("_staging*"))
    with pytest.raises(OSError):
        outputs.write_files(spark.createDataFrame(rows[:2], "name string, content string"), "nosuch://place/out")


def test_jpeg_is_read_by_spark(spark, tmp_path):
    rng = np.random.default_rng(2)
    y, x = np.mgrid[0:203, 0:317]
    smooth = np.stack([x * 255 / 316, y * 255 / 202, 128 + 100 * np.sin(x / 20)], -1).astype(np.uint8)
    pictures = {"smooth": smooth, "grey": smooth[..., 1:2], "noise": rng.integers(0, 256, (64, 50, 1), dtype=np.uint8), "spots": (rng.random((150, 90, 1)) < 0.002).astype(np.uint8) * 255, "one": np.full((1, 1, 3), 200, np.uint8), "flat": np.full((9, 17, 1), 77, np.uint8)}
    rows = [(k, (k, *p.shape, 0, p.tobytes())) for k, p in pictures.items()] + [("empty", ("empty", 0, 0, 1, 0, b"")), ("null", None)]
    df = spark.createDataFrame(rows, "name string, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    files = outputs.image_files(df, F.concat("name", F.lit(".jpg")), lambda: outputs.jpeg(95))
    assert {r.name for r in files.filter("content is null").collect()} == {"empty.jpg", "null.jpg"}
    outputs.write_files(files, f"file://{tmp_path}/jpg")
    got = {r.path.split("/")[-1][:-4]: r.image for r in scans.images(spark, f"file://{tmp_path}/jpg").collect()}
    assert got.keys() == pictures.keys()
    for name, most in {"smooth": 4, "grey": 4, "noise": 10, "spots": 10, "one": 1, "flat": 1}.items():
        own = np.frombuffer(bytes(got[name].data), np.uint8).reshape(got[name].height, got[name].width, got[name].nChannels)
        assert own.shape == pictures[name].shape and abs(own.astype(int) - pictures[name]).max() <= most, name


def test_jpeg_codes_fit():
    counts = np.zeros(256, int)
    counts[:40] = [int(1.6**i) for i in range(40)]  # Huffman's own codes would be longer than 16
    lengths = jpeg.code_lengths(counts)
    assert max(lengths.values()) <= 16 and len(lengths) == 40 and sum(2.0**-x for x in lengths.values()) < 1
    code, size = jpeg.codes(lengths)
    written = {format(code[s], f"0{size[s]}b") for s in lengths}
    assert not any(a != b and b.startswith(a) for a in written for b in written) and not any(set(w) == {"1"} for w in written)
    assert jpeg.code_lengths(np.eye(1, 256, 7, dtype=int)[0]) == {7: 1} and jpeg.code_lengths(np.zeros(256, int)) == {}
