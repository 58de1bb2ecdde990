"""Deterministic stand-ins for documents, judges and recognizers, for queries and tests; nothing here reads text from pixels."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Dots of a line and bytes of a page of a laid-out text.
LINE, PAGE_BYTES = 40, 10_000


class TextDocument:
    """A text laid out as grey pages, a byte a dot, LINE dots a line; the last line of a page is filled with spaces."""

    def __init__(self, content: bytes):
        self.parts = [content[at : at + PAGE_BYTES] for at in range(0, len(content), PAGE_BYTES)]

    def page_count(self) -> int:
        return len(self.parts)

    def page_size(self, index: int) -> tuple[float, float]:
        return float(LINE), float(-(-len(self.parts[index]) // LINE))

    def metadata(self) -> dict[str, str]:
        return {"pages": str(len(self.parts)), "bytes": str(sum(map(len, self.parts)))}

    def render(self, index: int, dpi: int) -> tuple[int, int, bytes]:
        part = self.parts[index]
        height = -(-len(part) // LINE)
        return LINE, height, part.ljust(height * LINE)

    def close(self) -> None:
        self.parts = []


class FinerDocument(TextDocument):
    """A text laid out on letter pages; drawn at a high resolution, a page has a line of # more."""

    FINE = 400

    def page_size(self, index: int) -> tuple[float, float]:
        self.parts[index]
        return 612.0, 792.0

    def render(self, index: int, dpi: int) -> tuple[int, int, bytes]:
        width, height, data = super().render(index, dpi)
        return (width, height + 1, data + b"#" * width) if dpi >= self.FINE else (width, height, data)


class UpsideDown:
    """A detector that finds every page of two lines and more, upside down."""

    def __call__(self, pixels: np.ndarray) -> tuple[float, np.ndarray] | None:
        h, w = pixels.shape[:2]
        return (1.0, np.array([[w - 1, h - 1], [0, h - 1], [0, 0], [w - 1, 0]], float)) if h > 1 else None


class FirstDot:
    """A judge that answers by the first dot of an image: upside down for 1 modulo 4, a spread for an even one, warped for a multiple of 5, hardly readable for one of 7."""

    def __call__(self, image: Any) -> str:
        dot = image["data"][0]
        return json.dumps({"recommended_angle": 180 if dot % 4 == 1 else 0, "page_count": 2.0 if dot % 2 == 0 else "1", "has_table_elements": dot % 3, "confidence_score": 0.5, "needs_dewarping": dot % 5 == 0, "readability_issues": "major" if dot % 7 == 0 else "none"})


class Shifted:
    """A detector whose corners are the image's own, moved by up to two pixels as its first two dots say."""

    def __call__(self, pixels: np.ndarray) -> tuple[float, np.ndarray]:
        h, w = pixels.shape[:2]
        move = np.array([int(pixels[0, 0, 0]) % 5 - 2, int(pixels[0, 1, 0]) % 5 - 2], float)
        return 1.0, np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], float) + move


def fingerprint(image: Any) -> str:
    return hashlib.md5(image["data"]).hexdigest()


class FingerprintRecognizer:
    """Answers with the digests of a group's images, one a line."""

    def __call__(self, images: list[Any]) -> str:
        return "```json\n" + json.dumps({"extracted_text": "\n".join(map(fingerprint, images))}) + "\n```"


class FingerprintImageRecognizer:
    """Answers with the digest of an image."""

    def __call__(self, image: Any) -> tuple[str, float]:
        return fingerprint(image), 1.0


#: How a scanned document may be stored; the last is no document.
PLAIN, PACKED, UPDATED, DAMAGED, FOREIGN = range(5)


class PdfWriter:
    """A text as a PDF of scanned pages: each PAGE_BYTES of it are an image, a byte a dot, on a page of its size in points.

    PACKED has object and cross-reference streams, a nested page tree and pages
    upside down; UPDATED an appended title; DAMAGED wrong cross-references.
    """

    def __init__(self, content: bytes, kind: int, title: str):
        self.kind, self.title = kind, title
        self.parts = [content[at : at + PAGE_BYTES] for at in range(0, len(content), PAGE_BYTES)]
        self.out, self.places = bytearray(b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n"), {}

    def add(self, number: int, body: bytes) -> None:
        self.places[number] = len(self.out)
        self.out += b"%d 0 obj\n%s\nendobj\n" % (number, body)

    @staticmethod
    def stream(entries: bytes, data: bytes) -> bytes:
        data = zlib.compress(data)
        return b"<< %s /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (entries, len(data), data)

    def objects(self) -> Iterator[tuple[int, bytes]]:
        """Catalog 1, page tree 2, information 3; from 10 on a page, its contents, its image and a node of the tree."""
        n = len(self.parts)
        firsts = [10 + 4 * k for k in range(n)]
        deep = self.kind == PACKED
        kids = b" ".join(b"%d 0 R" % (f + 3 if deep else f) for f in firsts)
        yield 1, b"<< /Type /Catalog /Pages 2 0 R >>"
        yield 2, b"<< /Type /Pages /Kids [%s] /Count %d %s >>" % (kids, n, b"/Rotate 180" if deep else b"")
        yield 3, b"<< /Title (%s) /Producer <FEFF0071> >>" % (b"old" if self.kind == UPDATED else self.escaped())
        for first, part in zip(firsts, self.parts, strict=True):
            lines = -(-len(part) // LINE)
            box = b"/MediaBox [0 0 %d %d]" % (LINE, lines)
            own = b"/Resources << /XObject << /Im %d 0 R >> >>" % (first + 2)
            yield first, b"<< /Type /Page /Parent %d 0 R /Contents %d 0 R %s >>" % (first + 3 if deep else 2, first + 1, b"" if deep else box + own)
            yield first + 1, self.stream(b"", b"q %d 0 0 %d 0 0 cm /Im Do Q" % (LINE, lines))
            shape = b"/Type /XObject /Subtype /Image /Width %d /Height %d /ColorSpace /DeviceGray /BitsPerComponent 8" % (LINE, lines)
            yield first + 2, self.stream(shape, part.ljust(lines * LINE))
            if deep:
                yield first + 3, b"<< /Type /Pages /Parent 2 0 R /Kids [%d 0 R] /Count 1 %s %s >>" % (first, box, own)

    def escaped(self) -> bytes:
        return self.title.encode("latin-1", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)")

    def table(self, first: bytes, rows: dict[int, int]) -> bytes:
        at, size = len(self.out), max(self.places, default=0) + 1
        lines = b"".join(b"%d 1\n%010d 00000 n \n" % x for x in sorted(rows.items()))
        return b"xref\n0 1\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R /Info 3 0 R %s >>\nstartxref\n%d\n%%%%EOF\n" % (lines, size, first, at)

    def bytes(self) -> bytes:
        if self.kind == FOREIGN:
            return b"".join(self.parts)
        packed = []
        for number, body in self.objects():
            if self.kind == PACKED and b"stream" not in body:
                packed.append((number, body))
            else:
                self.add(number, body)
        if self.kind == PACKED:
            return self._packed(packed)
        start = len(self.out)
        self.out += self.table(b"", self.places)
        if self.kind == UPDATED:
            self.add(3, b"<< /Title (%s) >>" % self.escaped())
            self.out += self.table(b"/Prev %d" % start, {3: self.places[3]})
        return bytes(self.out.replace(b"startxref\n", b"startxref\n7") if self.kind == DAMAGED else self.out)

    def _packed(self, packed: list[tuple[int, bytes]]) -> bytes:
        heads, bodies = [], b""
        for number, body in packed:
            heads.append(b"%d %d" % (number, len(bodies)))
            bodies += body + b" "
        head = b" ".join(heads) + b" "
        self.add(4, self.stream(b"/Type /ObjStm /N %d /First %d" % (len(packed), len(head)), head + bodies))
        rows = {number: (2, 4, k) for k, (number, _) in enumerate(packed)} | {n: (1, at, 0) for n, at in self.places.items()}
        rows |= {0: (0, 0, 0), 5: (1, len(self.out), 0)}
        numbers = sorted(rows)
        lines = [bytes([rows[n][0]]) + rows[n][1].to_bytes(4, "big") + rows[n][2].to_bytes(2, "big") for n in numbers]
        up = [bytes([2]) + bytes((x - y) & 255 for x, y in zip(own, above, strict=True)) for own, above in zip(lines, [bytes(7), *lines], strict=False)]
        index = b" ".join(b"%d 1" % n for n in numbers)
        entries = b"/Type /XRef /Size %d /W [1 4 2] /Index [%s] /Root 1 0 R /Info 3 0 R /DecodeParms << /Predictor 12 /Columns 7 >>" % (numbers[-1] + 1, index)
        at = len(self.out)
        self.add(5, self.stream(entries, b"".join(up)))
        return bytes(self.out + b"startxref\n%d\n%%%%EOF\n" % at)


def as_pdfs(docs: DataFrame) -> DataFrame:
    """session_id, path, content: documents (session_id, path, content: a text, kind, title) as PDF files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, titles = (batch.column(c).to_pylist() for c in ("kind", "title"))
            files = [PdfWriter(text.as_py() or b"", kind, title or "").bytes() for text, kind, title in zip(batch.column("content"), kinds, titles, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("session_id"), batch.column("path"), pa.array(files, pa.binary())], ["session_id", "path", "content"])

    own = docs.selectExpr("session_id", "path", "cast(content as binary) as content", "kind", "title")
    return own.mapInArrow(run, "session_id string, path string, content binary")
