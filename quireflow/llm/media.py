"""Content-addressed media columns in tar shards (operator 9).

A payload becomes a PNG of 8-bit RGB samples, 64 pixels (192 bytes) a row; the
file is stored in a tar shard under its payload's SHA-256 and rows carry digest,
shard, offset and length.  Each writing task stores a payload once; over all
shards the manifest gives every digest one place.  Columns of the media's
header are filled by range reads of the first bytes only.

Shards are written through a file-system URI into the shared folder, with names
that are new for every attempt of a task: a lost executor leaves an orphan file
and no wrong row.  Places are written as a table before anyone reads them.

Defined results: a null text counts as empty; every payload has at least one
row of samples; equal payloads share one place; with no row there is no shard.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import chunks, materialize, small_batches, work_path

ROW_BYTES, CHANNELS = 192, 3
#: A shard is closed when it holds as much.
SHARD_BYTES = 64 << 20
#: Signature and IHDR: all that the header columns need.
HEADER_BYTES = 33
#: Stored bytes that one task reads back.
READ_BYTES = 32_000_000
COMPRESSION = 6
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def pad_payload(data: bytes) -> bytes:
    """Spaces up to a positive multiple of ROW_BYTES."""
    return data.ljust(max(1, -(-len(data) // ROW_BYTES)) * ROW_BYTES, b" ")


def _png_chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes) -> bytes:
    """A PNG whose unfiltered 8-bit RGB samples are the payload."""
    rows = len(payload) // ROW_BYTES
    samples = np.zeros((rows, ROW_BYTES + 1), np.uint8)
    samples[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, ROW_BYTES)
    header = struct.pack(">IIBBBBB", ROW_BYTES // CHANNELS, rows, 8, 2, 0, 0, 0)
    return _SIGNATURE + _png_chunk(b"IHDR", header) + _png_chunk(b"IDAT", zlib.compress(samples.tobytes(), COMPRESSION)) + _png_chunk(b"IEND", b"")


def read_header(head: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth and channels from the first HEADER_BYTES of a file."""
    if len(head) < HEADER_BYTES or head[:8] != _SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    width, height, depth, colour = struct.unpack(">IIBB", head[16:26])
    return width, height, depth, {0: 1, 2: 3, 4: 2, 6: 4}[colour]


def decode_png(media: bytes) -> bytes:
    """The samples of a PNG that encode_png() made."""
    width, height, _, channels = read_header(media[:HEADER_BYTES])
    at, body = 8, []
    while at < len(media):
        (size,) = struct.unpack(">I", media[at : at + 4])
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + data):
            raise ValueError("a chunk's checksum is wrong")
        if kind == b"IDAT":
            body.append(data)
        at += size + 12
    samples = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width * channels + 1)
    if samples[:, 0].any():
        raise ValueError("filtered rows are not expected here")
    return samples[:, 1:].tobytes()


class ShardWriter:
    """Appends files to tar shards below a URI; remembers where each digest lies."""

    def __init__(self, uri: str):
        self.fs, self.root = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.root, recursive=True)
        self.out, self.name, self.at = None, "", 0
        self.places: dict[str, tuple[str, int, int]] = {}

    def add(self, digest: str, media: bytes) -> None:
        if self.out is None or self.at >= SHARD_BYTES:
            self.close()
            self.name, self.at = f"shard-{uuid.uuid4().hex}.tar", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}")
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(media)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.out.write(head + media + b"\0" * (-len(media) % tarfile.BLOCKSIZE))
        self.places[digest] = (self.name, self.at + len(head), len(media))
        self.at += len(head) + len(media) + -len(media) % tarfile.BLOCKSIZE

    def close(self) -> None:
        if self.out is not None:
            self.out.write(b"\0" * (2 * tarfile.BLOCKSIZE))
            self.out.close()
            self.out = None


class ShardReader:
    """Range reads below a URI."""

    def __init__(self, uri: str):
        self.fs, self.root = pafs.FileSystem.from_uri(uri)
        self.name, self.file = "", None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = shard, self.fs.open_input_file(f"{self.root}/{shard}")
        return self.file.read_at(length, offset)


def write_media(docs: DataFrame, uri: str) -> DataFrame:
    """Store every row's text; doc_id, n_bytes, payload_bytes, digest, shard, offset, length."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, waiting = None, []
        for batch in chunks(batches):
            if writer is None:
                writer = ShardWriter(uri)
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode()
                payload = pad_payload(data)
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in writer.places:
                    writer.add(digest, encode_png(payload))
                rows.append((doc_id, len(data), len(payload), digest, *writer.places[digest]))
            waiting.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names))
        if writer is not None:
            writer.close()  # rows leave only when their bytes are stored
        yield from waiting

    names = ["doc_id", "n_bytes", "payload_bytes", "digest", "shard", "offset", "length"]
    types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, digest string, shard string, offset long, length long")


def manifest(rows: DataFrame) -> DataFrame:
    """One place for every digest."""
    place = F.min(F.struct("shard", "offset", "length")).alias("place")
    return rows.groupBy("digest").agg(place).select("digest", "place.*")


def header_columns(places: DataFrame, uri: str) -> DataFrame:
    """Adds width, height, bit_depth, channels from header-only range reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(uri)
        for batch in batches:
            found = [read_header(reader.read(s, o, HEADER_BYTES)) for s, o in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True)]
            cols = [pa.array([f[i] for f in found], pa.int32()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, "width", "height", "bit_depth", "channels"])

    return places.mapInArrow(run, "digest string, shard string, offset long, length long, width int, height int, bit_depth int, channels int")


def feature_of(payload: bytes) -> str:
    """Mean of each channel, mean absolute step between neighbours, and a 64-bit average hash of an 8 x 8 grid."""
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, CHANNELS).astype(np.float64)
    grey = pixels.mean(1)
    step = np.abs(np.diff(grey)).mean()
    cells = np.array([c.mean() if len(c) else 0.0 for c in np.array_split(grey, 64)])
    bits = np.packbits(cells > cells.mean()).tobytes().hex()
    return ";".join([*(f"{m:.3f}" for m in pixels.mean(0)), f"{step:.3f}", bits])


def read_features(places: DataFrame, uri: str) -> DataFrame:
    """Read every stored file back and compute its digest columns, one row per digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(uri)
        for batch in batches:
            rows = []
            for digest, shard, offset, length, width, height in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                media = reader.read(shard, offset, length)
                payload = decode_png(media)
                if len(payload) != width * height * CHANNELS or hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"stored bytes of {digest} differ from what was written")
                rows.append((digest, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(payload), width, height))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names = ["digest", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()]
    src = places.select("digest", "shard", "offset", "length", "width", "height")
    return src.mapInArrow(run, "digest string, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int")


def media_table(docs: DataFrame, uri: str | None = None) -> DataFrame:
    """One row per document: its sizes, place and what the stored bytes give when read back.

    Only digests and places are shuffled, never payloads; a task reads back about
    READ_BYTES of neighbouring files at most, however small their rows are.  The join that spreads
    a digest's features over its documents is left to adaptive skew splitting.
    """
    spark = docs.sparkSession
    uri = uri or work_path(spark, "media")
    rows = materialize(write_media(docs, uri), "media-rows")
    stored = rows.agg(F.sum("length")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // READ_BYTES))
    near = lambda df: df.repartitionByRange(parts, "shard", "offset").sortWithinPartitions("shard", "offset")
    places = materialize(header_columns(near(manifest(rows)), uri), "media-places")
    read = read_features(near(places), uri).drop("width", "height")
    own = rows.select("doc_id", "n_bytes", "payload_bytes", "digest")
    return own.join(read.join(places, "digest"), "digest")
