"""Pixel kernels over image structs (origin, height, width, nChannels, mode, data).

Cutting strips is a slice of row-major bytes and needs no Python.  Rotation and
dewarping run as Arrow batches of few rows, for one page is megabytes; images
with nothing to do are routed past them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.config import Dewarp
from quireflow.operators.corners import bends
from quireflow.schemas import IMAGE
from quireflow.sinks.committed import file_system

#: Images that a pixel kernel works on at once.
IMAGES_PER_BATCH = 4


class Skipped(Exception):
    """Nothing to do for an image."""


class Detector(Protocol):
    """Finds a document in pixels: (confidence, four corners clockwise from top left), or None."""

    def __call__(self, pixels: np.ndarray) -> tuple[float, np.ndarray] | None: ...


def slice_rows(image: Column, start: Column, end: Column) -> Column:
    """The rows [start, end) of an image struct, without decoding a pixel."""
    line = image["width"] * image["nChannels"]
    data = F.substring(image["data"], start * line + 1, (end - start) * line)
    return F.struct(image["origin"].alias("origin"), (end - start).cast("int").alias("height"), image["width"].alias("width"), image["nChannels"].alias("nChannels"), image["mode"].alias("mode"), data.alias("data"))


def packed(df: DataFrame, folder: str, image: str = "image") -> DataFrame:
    """The other columns and ``place``: where the image's pixels, if any, stand in a file below ``folder`` that has those of all images of a task.

    Each attempt writes a file of its own, so the rows should be written as a
    table at once; a reference to all rows of an image, or to some, is its place
    followed by ``:first-last``.
    """
    carried = [c for c in df.columns if c != image]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        task = TaskContext.get()
        name, out, at = f"{task.stageId()}-{task.partitionId()}-{task.taskAttemptId()}.pixels", None, 0
        try:
            for batch in batches:
                places = []
                for own in batch.column(image):
                    if not own.is_valid or not own["data"].is_valid:
                        places.append(None)
                        continue
                    if out is None:
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(f"{root}/{name}")
                    data = own["data"].as_buffer()
                    places.append(f"{folder}/{name}#{at},{','.join(str(own[k].as_py()) for k in ('height', 'width', 'nChannels'))}")
                    out.write(data)
                    at += data.size
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(places, pa.string())], [*carried, "place"])
        finally:
            if out is not None:
                out.close()

    own = df.select(*carried, image)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    return own.mapInArrow(run, f"{fields}place string")


def read_raw(reference: str) -> dict:
    """The image at a place, or its rows a to b where ``:a-b`` follows; read where it is needed, and no more of it."""
    path, _, place = reference.rpartition("#")
    place, _, lines = place.partition(":")
    at, height, width, channels = map(int, place.split(","))
    start, end = map(int, lines.split("-")) if lines else (0, height)
    system, own = file_system(path)
    with system.open_input_file(own) as f:
        f.seek(at + start * width * channels)
        data = f.read((end - start) * width * channels)
    return {"origin": path, "height": end - start, "width": width, "nChannels": channels, "mode": 0, "data": data}


def pixels_of(row) -> np.ndarray:
    return np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["nChannels"])


_FIELDS = [x.split()[0] for x in IMAGE.split(", ")]


def _struct(row, pixels: np.ndarray) -> dict:
    return {"origin": row["origin"], "height": pixels.shape[0], "width": pixels.shape[1], "nChannels": pixels.shape[2], "mode": row["mode"], "data": pixels.tobytes()}


def map_images(df: DataFrame, image: str, fn: Callable[[np.ndarray, dict], np.ndarray], extra: list[str]) -> DataFrame:
    """Replace an image column by fn(pixels, the row's other columns); a failure keeps the image and fills ``error``.

    Pixels are views of the Arrow buffers.  A null image passes as it is.
    """
    names = [*extra, image, "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, IMAGES_PER_BATCH):
                batch = whole.slice(at, IMAGES_PER_BATCH)
                own = batch.column(len(extra))
                rows = batch.select(extra).to_pylist() if extra else [{}] * batch.num_rows
                images, errors = [], []
                for cell, row in zip(own, rows, strict=True):
                    got, error = None, None
                    if cell.is_valid:
                        got = {k: cell["data"].as_buffer() if k == "data" and cell["data"].is_valid else cell[k].as_py() for k in _FIELDS}
                        try:
                            got = _struct(got, fn(pixels_of(got), row))
                        except Exception as e:  # an error is a row, not a lost job
                            got, error = cell.as_py(), f"{type(e).__name__}: {e}"
                    images.append(got)
                    errors.append(error)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(extra)], pa.array(images, own.type), pa.array(errors, pa.string())], names)

    own = df.select(*extra, image)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields if f.name != image)
    kind = IMAGE.replace(" int", ":int").replace(" string", ":string").replace(" binary", ":binary")
    return own.mapInArrow(run, f"{fields + ', ' if fields else ''}`{image}` struct<{kind}>, error string")


def cut_columns(df: DataFrame, image: str = "image", start: str = "start_x", end: str = "end_x") -> DataFrame:
    """The columns [start, end) of each row's image, as the halves of a spread are cut; adds ``error``."""
    extra = [c for c in df.columns if c != image]
    return map_images(df, image, lambda px, row: px[:, row[start] : row[end]], extra)


def bilinear(pixels: np.ndarray, x: np.ndarray, y: np.ndarray, border: int = 255) -> np.ndarray:
    """Sample pixels at (x, y); places outside take the border value."""
    h, w = pixels.shape[:2]
    x0, y0 = np.floor(x).astype(np.int64), np.floor(y).astype(np.int64)
    fx, fy = (x - x0)[..., None], (y - y0)[..., None]

    def at(yy: np.ndarray, xx: np.ndarray) -> np.ndarray:
        inside = (xx >= 0) & (xx < w) & (yy >= 0) & (yy < h)
        got = pixels[np.clip(yy, 0, h - 1), np.clip(xx, 0, w - 1)].astype(np.float64)
        return np.where(inside[..., None], got, float(border))

    top = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx
    low = at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


#: Side of the output tiles that are sampled at once.
TILE = 256


def remap(pixels: np.ndarray, shape: tuple[int, int], source: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], border: int = 255, tile: int = TILE) -> np.ndarray:
    """An image of this shape whose pixel (x, y) is sampled at source(x, y).

    Worked tile by tile, each from the window of pixels that it needs, so what
    is held beside both images is bounded by the tile.
    """
    h, w = shape
    out = np.empty((h, w, pixels.shape[2]), np.uint8)
    for top in range(0, h, tile):
        for left in range(0, w, tile):
            y, x = np.mgrid[top : min(top + tile, h), left : min(left + tile, w)].astype(float)
            x, y = source(x, y)
            x0, y0 = (int(np.clip(np.floor(v.min()), 0, n)) for v, n in ((x, pixels.shape[1]), (y, pixels.shape[0])))
            x1, y1 = (int(np.clip(np.floor(v.max()) + 2, 0, n)) for v, n in ((x, pixels.shape[1]), (y, pixels.shape[0])))
            part = out[top : top + tile, left : left + tile]
            if x0 >= x1 or y0 >= y1:
                part[:] = border
            else:
                part[:] = bilinear(pixels[y0:y1, x0:x1], x - x0, y - y0, border)
    return out


def turn(pixels: np.ndarray, angle: int, compat: bool = False) -> np.ndarray:
    """Rotate by an angle, 90 meaning clockwise (``compat``: the other way); other angles enlarge the canvas, white."""
    angle = int(angle)
    if angle == 0:
        return pixels
    quarter = {90: -1, -90: 1, 180: 2, -180: 2}.get(angle)
    if quarter is not None:
        return np.ascontiguousarray(np.rot90(pixels, -quarter if compat and abs(quarter) == 1 else quarter))
    h, w = pixels.shape[:2]
    a = math.radians(angle if compat else -angle)
    cos, sin = abs(math.cos(a)), abs(math.sin(a))
    nw, nh = int(h * sin + w * cos), int(h * cos + w * sin)

    def source(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = x - nw / 2, y - nh / 2
        return math.cos(a) * x - math.sin(a) * y + w // 2, math.sin(a) * x + math.cos(a) * y + h // 2

    return remap(pixels, (nh, nw), source)


def rotate_images(df: DataFrame, image: str = "image", angle: str = "angle", compat: bool = False, extra: list[str] | None = None) -> DataFrame:
    """Rotate each image by its row's angle; rows with angle 0 or null never reach Python.

    The input is read twice, by angle: what costs or is not repeatable above it
    belongs in a table first.
    """
    extra = [c for c in (extra or df.columns) if c != image]
    still = F.coalesce(F.col(angle), F.lit(0)) == 0
    turned = map_images(df.filter(~still), image, lambda px, row: turn(px, row[angle], compat), extra)
    return df.filter(still).select(*extra, image, F.lit(None).cast("string").alias("error")).unionByName(turned)


def homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The 3 x 3 matrix that takes four points to four others."""
    rows, right = [], []
    for (x, y), (u, v) in zip(src, dst, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.append(np.linalg.solve(np.array(rows, float), np.array(right, float)), 1).reshape(3, 3)


def edge_shift(corners: np.ndarray, width: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Vertical shifts along the upper and the lower edge, one value per column."""
    ratio = np.arange(width) / max(width - 1, 1)
    at = ratio * (points - 1)
    low, high = np.floor(at), np.ceil(at)

    def along(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        y = lambda k: (a[1] + (b[1] - a[1]) * k / (points - 1)) * (1 - ratio)
        return np.where(low == high, 0.0, y(low) * (high - at) + y(high) * (at - low))

    return along(corners[0], corners[1]), along(corners[3], corners[2])


def dewarp_source(shape: tuple[int, int], corners: np.ndarray, cfg: Dewarp = Dewarp(), compat: bool = False, edges: tuple[np.ndarray, np.ndarray] | None = None) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Where pixels (x, y) of the straightened page come from.

    The documented intent applies the corners' homography and takes back how the
    edges bend (``edges``: polynomials of the upper and the lower one); ``compat``
    keeps the identity and shifts by the formula of the original.
    """
    h, w = shape

    def share(v: np.ndarray, n: int) -> np.ndarray:
        return v / max(n - 1, 1)

    if compat:
        upper, lower = edge_shift(corners, w, cfg.num_grid_lines) if cfg.enable_strong_correction and w > 1 and h > 1 else (np.zeros(w), np.zeros(w))

        def shifted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = x.astype(int)
            return x, y + (upper[at] * (1 - share(y, h)) + lower[at] * share(y, h)) * cfg.threshold_coefficient

        return shifted
    m = homography(np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], float), corners)
    upper, lower = edges or (np.zeros(1), np.zeros(1))

    def straight(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = m[2, 0] * x + m[2, 1] * y + m[2, 2]
        bent = np.polynomial.polynomial.polyval(share(x, w), upper) * (1 - share(y, h)) + np.polynomial.polynomial.polyval(share(x, w), lower) * share(y, h)
        return (m[0, 0] * x + m[0, 1] * y + m[0, 2]) / d, (m[1, 0] * x + m[1, 1] * y + m[1, 2]) / d + bent

    return straight


def dewarp_maps(shape: tuple[int, int], corners: np.ndarray, cfg: Dewarp = Dewarp(), compat: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The sampling maps (x, y) of a whole page."""
    y, x = np.mgrid[0 : shape[0], 0 : shape[1]].astype(float)
    return dewarp_source(shape, corners, cfg, compat)(x, y)


def dewarp(pixels: np.ndarray, detector: Detector, cfg: Dewarp = Dewarp(), compat: bool = False) -> tuple[np.ndarray, bool]:
    """The straightened page and whether it was left alone (nothing found with enough confidence)."""
    found = detector(pixels)
    if found is None or found[0] < cfg.confidence_threshold:
        return pixels, True
    corners = np.asarray(found[1], float)
    edges = bends(pixels, corners, cfg.num_grid_lines) if cfg.enable_strong_correction and not compat else None
    out = remap(pixels, pixels.shape[:2], dewarp_source(pixels.shape[:2], corners, cfg, compat, edges))
    m = cfg.crop_margin_px
    return (out[m : out.shape[0] - m, m : out.shape[1] - m] if m else out), False


def dewarp_images(df: DataFrame, detector: Callable[[], Detector], image: str = "image", cfg: Dewarp = Dewarp(), compat: bool = False) -> DataFrame:
    """Dewarp each image; ``detector`` builds the model once per worker.  Adds error and skipped (left as it was)."""
    held: dict[str, Detector] = {}
    extra = [c for c in df.columns if c != image]

    def fn(px: np.ndarray, row: dict) -> np.ndarray:
        if "d" not in held:
            held["d"] = detector()
        out, skipped = dewarp(px, held["d"], cfg, compat)
        if skipped:
            raise Skipped
        return out

    out = map_images(df, image, fn, extra)
    skipped = F.coalesce(F.col("error").startswith(Skipped.__name__), F.lit(False))
    return out.select(*extra, image, F.when(~skipped, F.col("error")).alias("error"), skipped.alias("skipped"))


def differences(df: DataFrame, left: str, right: str, keys: list[str]) -> DataFrame:
    """The keys, mean and most: how far the samples of two images of one shape are apart; null where the shapes differ."""
    names = [*keys, "mean", "most"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, most = [], []
            for a, b in zip(batch.column(len(keys)), batch.column(len(keys) + 1), strict=True):
                sides = [np.frombuffer(x.as_buffer(), np.uint8).astype(np.int16) if x.is_valid else np.empty(0) for x in (a, b)]
                far = np.abs(sides[0] - sides[1]) if sides[0].shape == sides[1].shape and sides[0].size else None
                mean.append(None if far is None else float(far.mean()))
                most.append(None if far is None else int(far.max()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(mean, pa.float64()), pa.array(most, pa.int32())], names)

    same = (F.col(f"{left}.height") == F.col(f"{right}.height")) & (F.col(f"{left}.nChannels") == F.col(f"{right}.nChannels"))
    own = df.select(*keys, F.when(same, F.col(f"{left}.data")).alias("a"), F.when(same, F.col(f"{right}.data")).alias("b"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(keys)])
    return own.mapInArrow(run, f"{fields}, mean double, most int")


def bright_box(threshold: int = 128) -> Detector:
    """A stand-in detector: the bounding box of bright pixels."""

    def find(pixels: np.ndarray) -> tuple[float, np.ndarray] | None:
        on = pixels.mean(2) >= threshold
        rows, cols = np.flatnonzero(on.any(1)), np.flatnonzero(on.any(0))
        if not len(rows):
            return None
        x0, x1, y0, y1 = cols[0], cols[-1], rows[0], rows[-1]
        return 1.0, np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1]], float)

    return find


def mark_centre(pixels: np.ndarray, size: int = 8, colour: tuple[int, int, int] = (0, 0, 255)) -> np.ndarray:
    """A debug overlay: a five-pointed star in the middle."""
    h, w = pixels.shape[:2]
    y, x = np.mgrid[0:h, 0:w]
    angle, radius = np.arctan2(x - w / 2, h / 2 - y), np.hypot(x - w / 2, y - h / 2)
    wave = np.abs((angle / (2 * np.pi) * 5) % 1 - 0.5) * 2
    out = pixels.copy()
    out[radius <= size * (0.45 + 0.55 * wave)] = colour[: pixels.shape[2]]
    return out
