"""The structure of a PDF from its bytes: cross-references, objects, page tree, entries, and pages that are scans.

One reader serves one document inside a task.  It needs nothing but zlib and
numpy: cross-reference tables and streams, object streams, incremental updates
and, where the references are damaged, a scan for objects.  Pages inherit their
boxes, rotation and resources.  A page is drawn from the images it paints, as
scanned pages are; text and line art are not drawn, and a page without an image
that can be decoded says so by raising.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np

#: What separates tokens (fixed values of the format).
_BLANK, _STOP = rb"\x00\t\n\x0c\r ", rb"\x00\t\n\x0c\r ()<>\[\]{}/%"
_TOKEN = re.compile(
    rb"(?:[" + _BLANK + rb"]|%[^\r\n]*)*(?:(?P<ref>(\d+)[" + _BLANK + rb"]+(\d+)[" + _BLANK + rb"]+R(?![^" + _STOP + rb"]))|(?P<number>[+-]*(?:\d+\.?\d*|\.\d+))|(?P<name>/[^" + _STOP + rb"]*)"
    rb"|(?P<open><<|\[)|(?P<close>>>|\])|<(?P<hex>[0-9A-Fa-f" + _BLANK + rb"]*)>|(?P<string>\()|(?P<word>[^" + _STOP + rb"]+))"
)
_OBJECT = re.compile(rb"(?<!\d)(\d+)[" + _BLANK + rb"]+(\d+)[" + _BLANK + rb"]+obj(?![a-z])")
_IN_STRING = re.compile(rb"[()]|\\(?:[0-7]{1,3}|\r\n|[\s\S])")
_ESCAPED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\r\n": b"", b"\n": b"", b"\r": b""}
#: Objects may nest so deep, and a stream may unpack to so many bytes.
DEPTH, UNPACKED = 200, 1 << 30
#: Dots of a page that are drawn at once.
DRAWN_DOTS = 1 << 18
#: The page of a document that names none, in points.
LETTER = [0, 0, 612, 792]
#: Entries of the information dictionary by the name they get (fixed values).
ENTRIES = {"Title": "title", "Author": "author", "Subject": "subject", "Keywords": "keywords", "Creator": "creator", "Producer": "producer", "CreationDate": "creationDate", "ModDate": "modDate", "Trapped": "trapped"}


class Broken(ValueError):
    """A document or page that can't be read."""


class Name(str):
    """A name such as /Type, without its slash."""


class Word(bytes):
    """A keyword or operator."""


class Ref(NamedTuple):
    number: int
    generation: int


class Stream(NamedTuple):
    entries: dict[str, Any]
    data: bytes


class Lexer:
    """Objects of a piece of bytes, one after another."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def next(self, depth: int = 0) -> Any:
        """The next object; a Word at what is none, and at the end an empty one."""
        m = _TOKEN.match(self.data, self.at)
        if not m:
            self.at = len(self.data)
            return Word(b"")
        self.at, kind, got = m.end(), m.lastgroup, m[m.lastgroup]
        if depth > DEPTH:
            raise Broken("nested too deep")
        if m["ref"]:
            return Ref(int(m[2]), int(m[3]))
        if kind == "number":
            sign, digits = (-1 if b"-" in got else 1), got.lstrip(b"+-")
            return sign * (float(digits) if b"." in digits else int(digits))
        if kind == "name":
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda x: bytes([int(x[1], 16)]), got[1:]).decode("latin-1"))
        if kind == "hex":
            digits = re.sub(rb"[" + _BLANK + rb"]", b"", got)
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if kind == "string":
            return self._string()
        if kind == "open":
            items = list(self._until(Word(b">>" if got == b"<<" else b"]"), depth))
            return items if got == b"[" else {k: v for k, v in zip(items[::2], items[1::2], strict=False) if isinstance(k, Name)}
        return {b"true": True, b"false": False, b"null": None}.get(got, Word(got))

    def _until(self, end: Word, depth: int) -> Iterator[Any]:
        while (x := self.next(depth + 1)) != end or not isinstance(x, Word):
            if isinstance(x, Word) and x in (b"", b"endobj", b"stream"):
                raise Broken("an object has no end")
            yield x

    def _string(self) -> bytes:
        out, open_, start = [], 1, self.at
        for m in _IN_STRING.finditer(self.data, self.at):
            got = m[0]
            if got[:1] == b"\\":
                out.append(self.data[start : m.start()])
                own = got[1:]
                out.append(bytes([int(own, 8) & 255]) if own.isdigit() and own < b"8" else _ESCAPED.get(own, own))
                start = m.end()
                continue
            open_ += 1 if got == b"(" else -1
            if not open_:
                self.at = m.end()
                return b"".join([*out, self.data[start : m.start()]])
        raise Broken("a string has no end")


def inflate(data: bytes) -> bytes:
    """Deflated bytes; of a damaged stream what can be read."""
    reader, out = zlib.decompressobj(), b""
    try:
        out = reader.decompress(data, UNPACKED)
    except zlib.error:
        reader = zlib.decompressobj()
        parts = []
        try:
            for at in range(0, len(data), 64):
                parts.append(reader.decompress(data[at : at + 64]))
        except zlib.error:
            if not any(parts):
                raise Broken("a stream can't be unpacked") from None
        return b"".join(parts)
    if reader.unconsumed_tail:
        raise Broken("a stream unpacks to too many bytes")
    return out


def unpredicted(data: bytes, predictor: int, colours: int, bits: int, columns: int) -> bytes:
    """Undo the differences that a predictor stored: by line (PNG) or along it (2)."""
    step, width = max(1, colours * bits // 8), (colours * bits * columns + 7) // 8
    if predictor == 2:
        if bits != 8:
            raise Broken("a predictor of other than 8 bits")
        lines = np.frombuffer(data[: len(data) // width * width], np.uint8).reshape(-1, columns, colours)
        return np.cumsum(lines, axis=1, dtype=np.uint8).tobytes()
    whole = np.frombuffer(data[: len(data) // (width + 1) * (width + 1)], np.uint8).reshape(-1, width + 1)
    out, above = [], np.zeros(width, np.uint8)
    for kind, line in zip(whole[:, 0].tolist(), whole[:, 1:], strict=True):
        if kind == 1:
            own = np.cumsum(np.pad(line, (0, -width % step)).reshape(-1, step), axis=0, dtype=np.uint8).ravel()[:width]
        elif kind == 2:
            own = line + above
        elif kind in (3, 4):
            own = line.copy()
            for i in range(width):  # each byte needs the one before it
                a, b, c = (int(own[i - step]), int(above[i]), int(above[i - step])) if i >= step else (0, int(above[i]), 0)
                near = (a + b) // 2 if kind == 3 else min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                own[i] = (int(line[i]) + near) & 255
        else:
            own = line
        out.append(own)
        above = own
    return b"".join(x.tobytes() for x in out)


def text_of(value: Any) -> str:
    """A text string by its byte order mark, else byte by byte."""
    if not isinstance(value, bytes):
        return "" if value is None else str(value)
    for mark, code in ((b"\xfe\xff", "utf-16-be"), (b"\xff\xfe", "utf-16-le"), (b"\xef\xbb\xbf", "utf-8")):
        if value.startswith(mark):
            return value[len(mark) :].decode(code, "replace")
    return value.decode("latin-1")


class PdfDocument:
    """A document as :mod:`quireflow.sources.scans` opens it."""

    def __init__(self, content: bytes):
        self.data = content
        head = content[:1024].find(b"%PDF-")
        if head < 0:
            raise Broken("not a PDF")
        self.version = content[head + 5 : head + 8].decode("latin-1")
        self.places: dict[int, tuple[int, int, int]] = {}  # number: (0, offset, -) or (1, object stream, place in it)
        self.trailer: dict[str, Any] = {}
        self.loaded: dict[int, Any] = {}
        self.packed: dict[int, list[Any]] = {}
        try:
            self._read_references()
            self._leaves = self._pages()
        except (Broken, ValueError, KeyError, IndexError, TypeError, RecursionError):
            self.loaded.clear()
            self.packed.clear()
            self._find_objects()
            self._leaves = self._pages()

    # -- references -----------------------------------------------------------
    def _read_references(self) -> None:
        at = self.data.rfind(b"startxref")
        if at < 0:
            raise Broken("no cross-references")
        todo, seen = [Lexer(self.data, at + 9).next()], set()
        while todo:
            at = todo.pop(0)
            if not isinstance(at, int) or not 0 <= at < len(self.data) or at in seen:
                raise Broken("a cross-reference points nowhere")
            seen.add(at)
            lexer = Lexer(self.data, at)
            first = lexer.next()
            entries = self._read_table(lexer) if first == b"xref" else self._read_stream(at)
            for k, v in entries.items():
                self.trailer.setdefault(k, v)
            todo += [entries[k] for k in ("XRefStm", "Prev") if k in entries]
        if "Encrypt" in self.trailer:
            raise Broken("encrypted")

    def _read_table(self, lexer: Lexer) -> dict[str, Any]:
        while (first := lexer.next()) != b"trailer":
            count = lexer.next()
            if not isinstance(first, int) or not isinstance(count, int):
                raise Broken("a damaged cross-reference table")
            for number in range(first, first + count):
                offset, _, kind = lexer.next(), lexer.next(), lexer.next()
                if kind == b"n":
                    self.places.setdefault(number, (0, offset, 0))
                elif kind == b"f":
                    self.places.setdefault(number, (2, 0, 0))
                else:
                    raise Broken("a damaged cross-reference table")
        return lexer.next()

    def _read_stream(self, at: int) -> dict[str, Any]:
        own = self._object_at(at)[1]
        if not isinstance(own, Stream) or own.entries.get("Type") != "XRef":
            raise Broken("no cross-references")
        widths, data = own.entries["W"], self.unpacked(own)
        index, size = own.entries.get("Index", [0, own.entries["Size"]]), sum(widths)
        numbers = (n for first, count in zip(index[::2], index[1::2], strict=True) for n in range(first, first + count))
        for row, number in enumerate(numbers):
            cell, fields = data[row * size : row * size + size], []
            for w in widths:
                fields.append(int.from_bytes(cell[:w], "big") if w else None)
                cell = cell[w:]
            kind = 1 if fields[0] is None else fields[0]
            self.places.setdefault(number, {1: (0, fields[1] or 0, 0), 2: (1, fields[1] or 0, fields[2] or 0)}.get(kind, (2, 0, 0)))
        return own.entries

    def _find_objects(self) -> None:
        """Of a document whose references are damaged: every object that can be seen, the last of a number."""
        self.places, self.trailer = {int(m[1]): (0, m.start(), 0) for m in _OBJECT.finditer(self.data)}, {}
        for number in list(self.places):
            try:
                own = self.load(number)
                kind = own.entries.get("Type") if isinstance(own, Stream) else own.get("Type") if isinstance(own, dict) else None
                if kind == "ObjStm":
                    for place in range(len(self._unpack(number)[0])):
                        self.places.setdefault(self.packed[number][0][place], (1, number, place))
                elif kind == "XRef":
                    self.trailer |= {k: v for k, v in own.entries.items() if k in ("Root", "Info", "Encrypt")}
                elif kind == "Catalog":
                    self.trailer.setdefault("Root", Ref(number, 0))
            except (Broken, ValueError, KeyError, IndexError, TypeError):
                continue
        for m in re.finditer(rb"trailer", self.data):
            found = Lexer(self.data, m.end()).next()
            self.trailer |= found if isinstance(found, dict) else {}
        if "Encrypt" in self.trailer:
            raise Broken("encrypted")
        if "Root" not in self.trailer:
            raise Broken("no catalog")

    # -- objects --------------------------------------------------------------
    def _object_at(self, at: int) -> tuple[int, Any]:
        lexer = Lexer(self.data, at)
        number, generation, word = lexer.next(), lexer.next(), lexer.next()
        if word != b"obj" or not isinstance(number, int) or not isinstance(generation, int):
            raise Broken(f"no object at byte {at}")
        value = lexer.next()
        begin = re.compile(rb"[" + _BLANK + rb"]*stream\r?\n?").match(self.data, lexer.at)
        if not begin or not isinstance(value, dict):
            return number, value
        length = self.resolve(value.get("Length"))
        end = begin.end() + length if isinstance(length, int) else -1
        if end < 0 or not re.compile(rb"[" + _BLANK + rb"]*endstream").match(self.data, end):
            end = self.data.find(b"endstream", begin.end())
            if end < 0:
                raise Broken("a stream has no end")
        return number, Stream(value, self.data[begin.end() : end])

    def _unpack(self, number: int) -> list[Any]:
        """[numbers, objects] of an object stream."""
        if number not in self.packed:
            own = self.load(number)
            data, head = self.unpacked(own), Lexer(self.unpacked(own))
            pairs = [(head.next(), head.next()) for _ in range(self.resolve(own.entries["N"]))]
            first = self.resolve(own.entries["First"])
            self.packed[number] = [[n for n, _ in pairs], [Lexer(data, first + at).next() for _, at in pairs]]
        return self.packed[number]

    def load(self, number: int) -> Any:
        """The object of a number; one that isn't there is null."""
        if number not in self.loaded:
            kind, where, place = self.places.get(number, (2, 0, 0))
            if kind == 0:
                own, value = self._object_at(where)
                if own != number:
                    raise Broken(f"object {number} is not where it should be")
            elif kind == 1:
                numbers, objects = self._unpack(where)
                value = objects[place if place < len(numbers) and numbers[place] == number else numbers.index(number)]
            else:
                value = None
            self.loaded[number] = value
        return self.loaded[number]

    def resolve(self, value: Any) -> Any:
        for _ in range(DEPTH):
            if not isinstance(value, Ref):
                return value
            value = self.load(value.number)
        raise Broken("references in a ring")

    def unpacked(self, stream: Stream) -> bytes:
        """A stream's bytes, its filters undone."""
        many = lambda x: x if isinstance(x, list) else [] if x is None else [x]
        filters, parms = many(self.resolve(stream.entries.get("Filter"))), many(self.resolve(stream.entries.get("DecodeParms")))
        data = stream.data
        for k, own in enumerate(map(self.resolve, filters)):
            if own == "ASCIIHexDecode":
                digits = re.sub(rb"[^0-9A-Fa-f]", b"", data.split(b">")[0])
                data = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
            elif own == "FlateDecode":
                data = inflate(data)
                given = self.resolve(parms[k]) if k < len(parms) else None
                if given and self.resolve(given.get("Predictor", 1)) > 1:
                    data = unpredicted(data, *(self.resolve(given.get(x, y)) for x, y in (("Predictor", 1), ("Colors", 1), ("BitsPerComponent", 8), ("Columns", 1))))
            else:
                raise Broken(f"filter {own} is not known")
        return data

    # -- pages ----------------------------------------------------------------
    def _pages(self) -> list[dict[str, Any]]:
        """Leaves of the page tree in order, with what they inherit."""
        root = self.resolve(self.trailer.get("Root"))
        if not isinstance(root, dict):
            raise Broken("no catalog")
        out, seen, todo = [], set(), [(root.get("Pages"), {})]
        while todo:
            ref, above = todo.pop()
            if isinstance(ref, Ref):
                if ref.number in seen:
                    raise Broken("a ring in the page tree")
                seen.add(ref.number)
            node = self.resolve(ref)
            if not isinstance(node, dict):
                raise Broken("a page is missing")
            own = above | {k: node[k] for k in ("MediaBox", "CropBox", "Rotate", "Resources") if k in node}
            kids = self.resolve(node.get("Kids")) if node.get("Type") != "Page" else None
            if kids is None:
                out.append(node | own)
            else:
                todo += [(kid, own) for kid in reversed(kids)]
        return out

    def page_count(self) -> int:
        return len(self._leaves)

    def page(self, index: int) -> dict[str, Any]:
        if not 0 <= index < len(self._leaves):
            raise IndexError(f"no page {index}")
        return self._leaves[index]

    def _box(self, page: dict[str, Any]) -> tuple[float, float, float, float]:
        def of(key: str) -> list[float] | None:
            value = self.resolve(page.get(key))
            own = [self.resolve(x) for x in value] if isinstance(value, list) else []
            if len(own) != 4 or not all(isinstance(x, int | float) for x in own):
                return None
            return [min(own[0], own[2]), min(own[1], own[3]), max(own[0], own[2]), max(own[1], own[3])]

        media = of("MediaBox") or LETTER
        crop = of("CropBox") or media
        x0, y0, x1, y1 = max(crop[0], media[0]), max(crop[1], media[1]), min(crop[2], media[2]), min(crop[3], media[3])
        return tuple(map(float, media if x0 >= x1 or y0 >= y1 else (x0, y0, x1, y1)))

    def _turned(self, page: dict[str, Any]) -> int:
        angle = self.resolve(page.get("Rotate"))
        return int(angle) % 360 if isinstance(angle, int | float) and int(angle) % 90 == 0 else 0

    def page_size(self, index: int) -> tuple[float, float]:
        """Width and height in points, of the cropped page as it is shown."""
        page = self.page(index)
        x0, y0, x1, y1 = self._box(page)
        unit = self.resolve(page.get("UserUnit", 1))
        w, h = (x1 - x0) * unit, (y1 - y0) * unit
        return (h, w) if self._turned(page) in (90, 270) else (w, h)

    def metadata(self) -> dict[str, str]:
        info = self.resolve(self.trailer.get("Info"))
        own = {new: text_of(self.resolve(info[k])) for k, new in ENTRIES.items() if k in info} if isinstance(info, dict) else {}
        return {"format": f"PDF {self.version}"} | own

    # -- drawing --------------------------------------------------------------
    def _image(self, stream: Stream) -> np.ndarray:
        entries = {k: self.resolve(v) for k, v in stream.entries.items()}
        space = entries.get("ColorSpace")
        colours = {"DeviceGray": 1, "DeviceRGB": 3}.get("DeviceGray" if entries.get("ImageMask") else space if isinstance(space, str) else "", 0)
        w, h, bits = entries["Width"], entries["Height"], 1 if entries.get("ImageMask") else entries.get("BitsPerComponent", 8)
        data = self.unpacked(stream)
        if not colours or bits not in (1, 8) or bits == 1 and colours == 3:
            raise Broken(f"an image of {bits} bits in {space}")
        if bits == 8:
            return np.frombuffer(data[: h * w * colours], np.uint8).reshape(h, w, colours)
        lines = np.frombuffer(data, np.uint8).reshape(h, -1)
        return (np.unpackbits(lines, axis=1)[:, :w] * 255)[..., None]

    def _painted(self, page: dict[str, Any]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pixels, matrix from the unit square to the page) of every image the page paints."""
        contents = self.resolve(page.get("Contents"))
        parts = [self.resolve(x) for x in (contents if isinstance(contents, list) else [contents])]
        lexer = Lexer(b"\n".join(self.unpacked(x) for x in parts if isinstance(x, Stream)))
        named = self.resolve((self.resolve(page.get("Resources")) or {}).get("XObject")) or {}
        matrix, kept, given = np.eye(3), [], []
        while (x := lexer.next()) != b"" or not isinstance(x, Word):
            if not isinstance(x, Word):
                given.append(x)
                continue
            if x == b"ID":  # an inline image, whose bytes are no tokens
                lexer.at = max(lexer.at, lexer.data.find(b"EI", lexer.at))
            elif x == b"q":
                kept.append(matrix)
            elif x == b"Q" and kept:
                matrix = kept.pop()
            elif x == b"cm" and len(given) >= 6:
                a, b, c, d, e, f = given[-6:]
                matrix = np.array([[a, b, 0], [c, d, 0], [e, f, 1]], float) @ matrix
            elif x == b"Do" and given:
                own = self.resolve(named.get(given[-1]))
                if isinstance(own, Stream) and own.entries.get("Subtype") == "Image":
                    yield self._image(own), matrix
            given = []

    def render(self, index: int, dpi: int) -> tuple[int, int, bytes]:
        """Width, height and pixels (grey, or blue, green, red) of a page's images on white."""
        page = self.page(index)
        x0, y0, x1, y1 = self._box(page)
        zoom, turns = dpi / 72.0 * self.resolve(page.get("UserUnit", 1)), self._turned(page) // 90
        w, h = max(1, int((x1 - x0) * zoom)), max(1, int((y1 - y0) * zoom))
        painted = list(self._painted(page))
        if not painted:
            raise Broken("a page without an image")
        colours = max(px.shape[2] for px, _ in painted)
        out = np.full((h, w, colours), 255, np.uint8)
        across = x0 + (np.arange(w) + 0.5) / zoom
        for px, matrix in painted:
            if abs(np.linalg.det(matrix)) < 1e-12:
                continue
            back = np.linalg.inv(matrix)
            lines = max(1, DRAWN_DOTS // w)
            for row in range(0, h, lines):  # some lines at a time bound memory
                up = (y1 - (np.arange(row, min(row + lines, h)) + 0.5) / zoom)[:, None]
                u, v = across * back[0, 0] + up * back[1, 0] + back[2, 0], across * back[0, 1] + up * back[1, 1] + back[2, 1]
                inside = (u >= 0) & (u < 1) & (v > 0) & (v <= 1)
                at = np.minimum((1 - v[inside]) * px.shape[0], px.shape[0] - 1).astype(int), np.minimum(u[inside] * px.shape[1], px.shape[1] - 1).astype(int)
                out[row : row + lines][inside] = px[at]
        out = np.rot90(out[..., ::-1], -turns)
        return out.shape[1], out.shape[0], np.ascontiguousarray(out).tobytes()

    def close(self) -> None:
        self.loaded, self.packed, self._leaves = {}, {}, []
