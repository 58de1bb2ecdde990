"""Byte-level BPE (operator 2): a sentencepiece model serialised from a rank file.

The rank vocabulary is written directly as a ``ModelProto``: every piece is the
token's bytes mapped to printable characters, its score is the negative rank
(so the lowest rank merges first), ids equal ranks, the unknown piece stands
last, and normalisation is the identity.  Texts are cut into pre-tokens by the
tokenizer's pattern, each pre-token is encoded on its own, and decoding inverts
the byte mapping.

Defined results: a null text counts as empty; an empty text gives no ids and
the digests of the empty string; repeated rows give repeated results; other
columns of the input are not touched, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from quireflow.llm.charclass import find_all
from quireflow.llm.common import chunks, small_batches

#: Chunks of text kept with their ids in each worker; forgetting costs time only.
CACHE_ENTRIES = 250_000


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b) if b in shown else chr(free)
        free += b not in shown
    return out


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank) in the order of their ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        out.append(n & 127 | (128 if n > 127 else 0))
        n >>= 7
        if not n:
            return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialize_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose id is the rank; the unknown piece is the last."""
    alphabet = byte_alphabet()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(alphabet[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    none = (1 << 64) - 1  # -1: the model has no such piece
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(k, none) for k in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


class ByteBpe:
    """Encoder and decoder over one serialised model."""

    #: Splits at white space as the token pattern does, so that its pieces can be looked up whole.
    _COARSE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
    #: The separators on which ``re`` and the pattern's ``\s`` disagree.
    _ODD = re.compile("[\x1c-\x1f]")

    def __init__(self, model: bytes, pattern: str, tokens: list[bytes]):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.tokens = tokens
        self.table = {b: c for b, c in enumerate(byte_alphabet())}
        self.cache: dict[str, bytes] = {}

    def _pretokens(self, texts: list[str]) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of each text, every match of the pattern on its own."""
        parts = [self.pattern.findall(t) if t.isascii() else [p for _, p in find_all(self.pattern, t)] for t in texts]
        flat = [p.encode().decode("latin-1").translate(self.table) for part in parts for p in part]
        ids = self.sp.encode(flat, num_threads=1) if flat else []
        out, at = [], 0
        for part in parts:
            out.append(np.array([i for x in ids[at : at + len(part)] for i in x], "<u4").tobytes())
            at += len(part)
        return out

    def encode_packed(self, text: str) -> bytes:
        if self._ODD.search(text):
            return self._pretokens([text])[0]
        pieces = self._COARSE.findall(text)
        new = list(set(pieces).difference(self.cache))
        if new:
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                self.cache.clear()
                new = list(set(pieces))
            self.cache.update(zip(new, self._pretokens(new), strict=True))
        return b"".join(map(self.cache.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row's text; ``keep_ids`` adds the ids.

    The rank file is read once on the driver and broadcast: its size is fixed by
    the tokenizer and does not grow with the data.  One map over the scan, no shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens = read_ranks(rank_path)
    shipped = spark.sparkContext.broadcast((serialize_model(tokens), tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary = shipped.value
        bpe = ByteBpe(model, pattern, vocabulary)
        for batch in chunks(batches):
            n, ids_sha, dec_sha, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                packed = bpe.encode_packed(text or "")
                ids = np.frombuffer(packed, "<u4")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                dec_sha.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
                if keep_ids:
                    kept.append(ids.astype(np.int32))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
