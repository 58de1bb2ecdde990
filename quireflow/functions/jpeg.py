"""Baseline JPEG from pixels, in numpy alone.

Every step runs over all blocks of a band at once: colour transform, cosine
transform by two matrix products, quantisation, zigzag, run lengths and bits.
Huffman codes are made for the image itself from the counts of its symbols, so
no code tables are needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Steps of the quantisation for brightness and colour at quality 50, row by row (fixed values).
BRIGHTNESS = [
    [16, 11, 10, 16, 24, 40, 51, 61],
    [12, 12, 14, 19, 26, 58, 60, 55],
    [14, 13, 16, 24, 40, 57, 69, 56],
    [14, 17, 22, 29, 51, 87, 80, 62],
    [18, 22, 37, 56, 68, 109, 103, 77],
    [24, 35, 55, 64, 81, 104, 113, 92],
    [49, 64, 78, 87, 103, 121, 120, 101],
    [72, 92, 95, 98, 112, 100, 103, 99],
]
COLOUR = [
    [17, 18, 24, 47, 99, 99, 99, 99],
    [18, 21, 26, 66, 99, 99, 99, 99],
    [24, 26, 56, 99, 99, 99, 99, 99],
    [47, 66, 99, 99, 99, 99, 99, 99],
    [99, 99, 99, 99, 99, 99, 99, 99],
    [99, 99, 99, 99, 99, 99, 99, 99],
    [99, 99, 99, 99, 99, 99, 99, 99],
    [99, 99, 99, 99, 99, 99, 99, 99],
]
#: Rows of blocks transformed at once, symbols written at once, and the longest code.
BAND, AT_ONCE, LONGEST = 16, 1 << 16, 16
#: Symbols for the end of a block and for sixteen zeros.
_END, _ZEROS = 0x00, 0xF0

#: Places of a block by diagonals, every second one upwards.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
_k = np.arange(8)
#: The cosine transform of eight samples as a matrix.
COSINES = np.cos((2 * _k[None] + 1) * _k[:, None] * np.pi / 16) * np.where(_k[:, None] == 0, np.sqrt(0.125), 0.5)


def steps(table: list[list[int]], quality: int) -> np.ndarray:
    """A table of steps at a quality of 1 to 100."""
    quality = min(100, max(1, quality))
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(table) * scale + 50) // 100, 1, 255)


def planes(pixels: np.ndarray) -> np.ndarray:
    """Brightness, or brightness and two colour differences of blue, green, red (and more) pixels, around zero."""
    if pixels.shape[2] < 3:
        return pixels[..., :1].astype(np.float32) - 128
    b, g, r = (pixels[..., i].astype(np.float32) for i in range(3))
    y = 0.299 * r + 0.587 * g + 0.114 * b
    return np.stack([y - 128, (b - y) / 1.772, (r - y) / 1.402], axis=-1)


def blocks(pixels: np.ndarray, tables: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Quantised coefficients in zigzag order, (blocks, colours, 64), by bands of the image; edges repeat the last pixel."""
    h, w = pixels.shape[:2]
    for top in range(0, h, 8 * BAND):
        part = pixels[top : top + 8 * BAND]
        own = planes(np.pad(part, ((0, -part.shape[0] % 8), (0, -w % 8), (0, 0)), mode="edge"))
        rows, columns, colours = own.shape[0] // 8, own.shape[1] // 8, own.shape[2]
        own = own.reshape(rows, 8, columns, 8, colours).transpose(0, 2, 4, 1, 3).reshape(-1, colours, 8, 8)
        own = COSINES @ own @ COSINES.T
        own = np.rint(own / np.stack([tables[min(c, 1)] for c in range(colours)])).astype(np.int32)
        yield own.reshape(-1, colours, 64)[..., ZIGZAG]


def bit_size(values: np.ndarray) -> np.ndarray:
    """Bits of the absolute values."""
    return np.frexp(np.abs(values).astype(np.float64))[1]


def symbols(zigzag: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Rows (code table, symbol, bits that follow, their number) of a band in the order they are written.

    ``before`` is the first coefficient of the last block of each colour.  Tables
    are 0 and 1 for the first coefficients and 2 and 3 for the others.
    """
    n, colours, _ = zigzag.shape
    first = zigzag[..., 0]
    step = (first - np.concatenate([before[None], first[:-1]])).ravel()
    flat = zigzag.reshape(-1, 64)
    kind = np.tile(np.minimum(np.arange(colours), 1), n)
    block, place = np.nonzero(flat[:, 1:])
    place = place + 1
    value = flat[block, place]
    last = np.where(np.append(True, block[1:] != block[:-1])[: len(block)], 0, np.append(0, place[:-1])[: len(block)])
    run = place - last - 1
    long_ = np.repeat(np.arange(len(run)), run // 16)
    ends = np.zeros(len(flat), np.int64)
    np.maximum.at(ends, block, place)
    open_ = np.nonzero(ends < 63)[0]

    def rows(at: np.ndarray, order: np.ndarray, table: np.ndarray, symbol: np.ndarray, v: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.stack([at, order, table, symbol, np.where(v < 0, v + (1 << size) - 1, v), size], axis=1)

    size, own, none = bit_size(step), bit_size(value), np.zeros
    parts = [
        rows(np.arange(len(flat)), none(len(flat), np.int64), kind, size, step, size),
        rows(block[long_], 2 * place[long_] - 1, kind[block[long_]] + 2, np.full(len(long_), _ZEROS), none(len(long_), np.int64), none(len(long_), np.int64)),
        rows(block, 2 * place, kind[block] + 2, run % 16 << 4 | own, value, own),
        rows(open_, np.full(len(open_), 200), kind[open_] + 2, np.full(len(open_), _END), none(len(open_), np.int64), none(len(open_), np.int64)),
    ]
    out = np.concatenate(parts)
    return out[np.argsort(out[:, 0] * 256 + out[:, 1], kind="stable"), 2:]


def code_lengths(counts: np.ndarray) -> dict[int, int]:
    """Code length by symbol: Huffman's, with codes longer than LONGEST made to fit and the code of all ones left free."""
    present = np.nonzero(counts)[0].tolist()
    groups = [(int(counts[s]), [s]) for s in present] + [(0, [-1])]  # the rarest of all takes the code of ones
    depth = dict.fromkeys([*present, -1], 0)
    while len(groups) > 1:
        groups.sort(key=lambda g: (-g[0], max(g[1])))
        (n, a), (m, b) = groups.pop(), groups.pop()
        for s in a + b:
            depth[s] += 1
        groups.append((n + m, a + b))
    order = sorted(depth, key=lambda s: (depth[s], s < 0, -int(counts[s]) if s >= 0 else 0))
    lengths = [min(max(depth[s], 1), LONGEST) for s in order]
    room = sum(1 << LONGEST - x for x in lengths) - (1 << LONGEST)
    while room > 0:  # lengthen the longest codes that are still short until all fit
        k = max((i for i, x in enumerate(lengths) if x < LONGEST), key=lambda i: (lengths[i], i))
        lengths[k] += 1
        room -= 1 << LONGEST - lengths[k]
    lengths.sort()
    return {s: x for s, x in zip(order, lengths, strict=True) if s >= 0}


def codes(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths by symbol: codes of a length are consecutive."""
    code, size, at = np.zeros(256, np.int64), np.zeros(256, np.int64), 0
    last = 0
    for s, x in lengths.items():
        at <<= x - last
        code[s], size[s], last = at, x, x
        at += 1
    return code, size


def packed(rows: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """The bits of all symbols; ones fill the last byte, and a zero byte follows each of 255."""
    code, size = (np.stack([t[i] for t in tables]) for i in (0, 1))
    out, left = [], np.empty(0, np.uint8)
    for at in range(0, len(rows), AT_ONCE):
        table, symbol, extra, more = rows[at : at + AT_ONCE].T
        value, length = code[table, symbol] << more | extra, size[table, symbol] + more
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        bits = (np.repeat(value, length) >> (np.repeat(length, length) - 1 - place) & 1).astype(np.uint8)
        bits = np.concatenate([left, bits])
        whole = len(bits) // 8 * 8
        out.append(np.packbits(bits[:whole]).tobytes())
        left = bits[whole:]
    if len(left):
        out.append(np.packbits(np.pad(left, (0, 8 - len(left)), constant_values=1)).tobytes())
    return b"".join(out).replace(b"\xff", b"\xff\x00")


def segment(mark: int, body: bytes) -> bytes:
    return bytes([0xFF, mark]) + (len(body) + 2).to_bytes(2, "big") + body


def encoder(quality: int = 95) -> Callable[[np.ndarray], bytes]:
    """An encoder of pixels (height, width, 1: grey, 3 or 4: blue, green, red) as JPEG."""
    tables = [steps(BRIGHTNESS, quality), steps(COLOUR, quality)]

    def encode(pixels: np.ndarray) -> bytes:
        h, w = pixels.shape[:2]
        if not 0 < h < 65536 or not 0 < w < 65536:
            raise ValueError(f"no JPEG of {w} x {h}")
        colours = 3 if pixels.shape[2] >= 3 else 1
        rows, before = [], np.zeros(colours, np.int64)
        for own in blocks(pixels, tables):
            rows.append(symbols(own, before).astype(np.int32))
            before = own[-1, :, 0]
        rows = np.concatenate(rows)
        lengths = []
        for table in range(4):
            lengths.append(code_lengths(np.bincount(rows[rows[:, 0] == table, 1], minlength=256)))
        used = range(min(colours, 2))
        out = [b"\xff\xd8", segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")]
        out += [segment(0xDB, bytes([i]) + bytes(tables[i].ravel()[ZIGZAG].tolist())) for i in used]
        out.append(segment(0xC0, bytes([8]) + h.to_bytes(2, "big") + w.to_bytes(2, "big") + bytes([colours]) + b"".join(bytes([c + 1, 0x11, min(c, 1)]) for c in range(colours))))
        for i in used:
            for table, kind in ((i, 0x00), (i + 2, 0x10)):
                own = lengths[table]
                sizes = bytes(sum(x == k for x in own.values()) for k in range(1, LONGEST + 1))
                out.append(segment(0xC4, bytes([kind | i]) + sizes + bytes(own)))
        out.append(segment(0xDA, bytes([colours]) + b"".join(bytes([c + 1, 0x11 * min(c, 1)]) for c in range(colours)) + b"\0\x3f\0"))
        return b"".join([*out, packed(rows, [codes(x) for x in lengths]), b"\xff\xd9"])

    return encode
