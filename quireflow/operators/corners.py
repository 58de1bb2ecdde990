"""Where a page lies in a picture: its corners, and how its upper and lower edges bend."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Least share of the picture that a page covers, and least gradient of an edge.
LEAST_SHARE, LEAST_STEP = 0.05, 12.0
#: How far an edge may bend from its chord, by the page's height, and how rough a bend may be, in pixels.
REACH, ROUGH = 0.12, 1.5


def steepness(grey: np.ndarray) -> np.ndarray:
    """The larger of the differences across and down at each pixel."""
    wide = np.pad(grey.astype(np.int16), 1, mode="edge")
    return np.maximum(np.abs(wide[1:-1, 2:] - wide[1:-1, :-2]), np.abs(wide[2:, 1:-1] - wide[:-2, 1:-1]))


def split_level(values: np.ndarray) -> float:
    """The level that parts a set of 0 to 510 into two with the most variance between them (Otsu)."""
    counts = np.bincount(values.ravel(), minlength=511).astype(float)
    below, total = np.cumsum(counts), np.cumsum(counts * np.arange(len(counts)))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (total / below - (total[-1] - total) / above) ** 2
    return float(np.nanargmax(between[:-1])) if np.isfinite(between[:-1]).any() else 0.0


def edge_points(grey: np.ndarray) -> np.ndarray:
    """The outermost steep pixels (x, y) of every row and column; single spots don't count."""
    steep = steepness(grey)
    on = steep >= max(LEAST_STEP, split_level(steep))
    near = np.pad(on.astype(np.uint8), 1)
    around = sum(near[1 + dy : near.shape[0] - 1 + dy, 1 + dx : near.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1))
    on &= around >= 4
    rows, columns = np.nonzero(on.any(axis=1))[0], np.nonzero(on.any(axis=0))[0]
    h, w = on.shape
    left, right = on.argmax(axis=1)[rows], w - 1 - on[:, ::-1].argmax(axis=1)[rows]
    top, bottom = on.argmax(axis=0)[columns], h - 1 - on[::-1].argmax(axis=0)[columns]
    return np.concatenate([np.stack(x, axis=1) for x in ((left, rows), (right, rows), (columns, top), (columns, bottom))]).astype(float)


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull in order (monotone chain)."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(chain(points) + chain(points[::-1]))


def area(polygon: np.ndarray) -> float:
    x, y = polygon[:, 0], polygon[:, 1]
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def largest_quadrilateral(polygon: np.ndarray) -> np.ndarray:
    """The four corners of a convex polygon that enclose most: as a diagonal turns, the farthest corners on its sides only go on."""
    n = len(polygon)
    p = [(float(x), float(y)) for x, y in polygon]

    def off(i: int, j: int, k: int) -> float:
        (ax, ay), (bx, by), (cx, cy) = p[i], p[j], p[k % n]
        return abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    best, found = -1.0, (0, 0, 0, 0)
    for i in range(n - 2):
        k, m = i + 1, i + 3
        for j in range(i + 2, n):
            while k + 1 < j and off(i, j, k + 1) >= off(i, j, k):
                k += 1
            m = max(m, j + 1)
            while m + 1 < n + i and off(i, j, m + 1) >= off(i, j, m):
                m += 1
            other = off(i, j, m) if m < n + i else 0.0
            if off(i, j, k) + other > best:
                best, found = off(i, j, k) + other, (i, k, j, m % n)
    return polygon[list(found)]


def from_top_left(corners: np.ndarray) -> np.ndarray:
    """Four corners clockwise, as one sees them, from the one nearest to the upper left."""
    middle = corners.mean(axis=0)
    own = corners[np.argsort(np.arctan2(corners[:, 1] - middle[1], corners[:, 0] - middle[0]))]
    return np.roll(own, -int(own.sum(axis=1).argmin()), axis=0)


def page_corners() -> Callable[[np.ndarray], tuple[float, np.ndarray] | None]:
    """A detector of one page against its ground.  Its confidence is how much of the hull of all edges four corners enclose."""

    def find(pixels: np.ndarray) -> tuple[float, np.ndarray] | None:
        if min(pixels.shape[:2]) < 3:
            return None
        outline = hull(edge_points(np.rint(pixels.mean(axis=2)).astype(np.int16)))
        if len(outline) < 4:
            return None
        whole = area(outline)
        if whole < LEAST_SHARE * pixels.shape[0] * pixels.shape[1]:
            return None
        corners = largest_quadrilateral(outline)
        return area(corners) / whole, from_top_left(corners)

    return find


def bend(grey: np.ndarray, start: np.ndarray, end: np.ndarray, points: int, reach: float) -> np.ndarray:
    """Polynomial (of the share of the way) of how far an edge lies below its chord; zero where no smooth edge is found."""
    none, share = np.zeros(1), np.linspace(0, 1, max(points, 4) + 2)[1:-1]
    off, at = [], []
    for s in share:
        x, y = start + (end - start) * s
        column, low, high = round(float(x)), max(1, round(float(y - reach))), min(grey.shape[0] - 1, round(float(y + reach)) + 1)
        if not 0 <= column < grey.shape[1] or high - low < 3:
            continue
        steep = np.abs(grey[low + 1 : high + 1, column].astype(float) - grey[low - 1 : high - 1, column])[: high - low]
        if len(steep) and steep.max() >= LEAST_STEP:
            on = np.nonzero(steep >= steep.max() / 2)[0]
            nearest = on[np.abs(on + low - y).argmin()]
            run = on[np.abs(on - nearest) <= 1]
            off.append(float(run.mean()) + low - y)
            at.append(s)
    if len(at) < max(4, len(share) // 2):
        return none
    fit = np.polynomial.polynomial.polyfit(at, off, 3)
    rough = np.sqrt(np.mean((np.polynomial.polynomial.polyval(np.array(at), fit) - off) ** 2))
    return fit if rough <= ROUGH and np.abs(off).max() > 1 else none


def bends(pixels: np.ndarray, corners: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Bends of the upper and the lower edge of a page with these corners."""
    grey = pixels.mean(axis=2)
    reach = REACH * max(1.0, float(np.abs(corners[[3, 2], 1] - corners[[0, 1], 1]).mean()))
    return bend(grey, corners[0], corners[1], points, reach), bend(grey, corners[3], corners[2], points, reach)
