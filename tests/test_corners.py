"""Corners of drawn pages, straightened pages, and sampling by tiles."""

import math

import numpy as np
import pytest

from quireflow.config import Dewarp
from quireflow.operators import corners, images


def drawn(corner, shape=(420, 380), ground=40, paper=225, noise=6, bow=0.0, seed=1):
    """A page with lines of text on a ground; its upper and lower edges sag by ``bow`` in the middle."""
    rng = np.random.default_rng(seed)
    h, w = shape
    y, x = np.mgrid[0:h, 0:w].astype(float)
    back = images.homography(np.array(corner, float), np.array([[0, 0], [1, 0], [1, 1], [0, 1]], float))

    def inside(yy):
        d = back[2, 0] * x + back[2, 1] * yy + back[2, 2]
        return (back[0, 0] * x + back[0, 1] * yy + back[0, 2]) / d, (back[1, 0] * x + back[1, 1] * yy + back[1, 2]) / d

    u, v = inside(y)
    u, v = inside(y - bow * 4 * np.clip(u, 0, 1) * (1 - np.clip(u, 0, 1)))
    px = np.full(shape, ground, float)
    page = (u >= 0) & (u <= 1) & (v >= 0) & (v <= 1)
    px[page] = paper
    px[page & (v * 30 % 1 > 0.5) & (u > 0.15) & (u < 0.85) & (v > 0.15) & (v < 0.85)] = 60
    return np.clip(px + rng.normal(0, noise, shape), 0, 255).astype(np.uint8)[..., None]


def turned(angle, shape=(420, 380), half=(110, 150)):
    a = math.radians(angle)
    rows = [(-half[0], -half[1]), (half[0], -half[1]), (half[0], half[1]), (-half[0], half[1])]
    return [(shape[1] / 2 + x * math.cos(a) - y * math.sin(a), shape[0] / 2 + x * math.sin(a) + y * math.cos(a)) for x, y in rows]


@pytest.mark.parametrize("angle", [0, 3, -8, 17, 30, -40])
@pytest.mark.parametrize("dark", [False, True])
def test_turned_pages(angle, dark):
    corner = turned(angle)
    sure, found = corners.page_corners()(drawn(corner, ground=225 if dark else 40, paper=60 if dark else 225))
    assert sure > 0.95 and np.abs(found - corners.from_top_left(np.array(corner))).max() <= 2


def test_pages_in_perspective_and_colour():
    corner = [(60, 50), (330, 80), (300, 370), (40, 340)]
    px = np.repeat(drawn(corner), 3, axis=2)
    px[400, 10] = px[5, 300] = 255  # spots are no edges
    sure, found = corners.page_corners()(px)
    assert sure > 0.95 and np.abs(found - corner).max() <= 2
    flat, skipped = images.dewarp(px, corners.page_corners(), Dewarp(enable_strong_correction=False))
    assert not skipped and flat[8:-8, 8:-8].min() > 30 and (flat[8:30, 8:-8] > 180).all() and (flat[8:-8, 8:30] > 180).all()


def test_nothing_and_other_shapes():
    find = corners.page_corners()
    assert find(np.full((50, 60, 1), 9, np.uint8)) is None and find(np.zeros((1, 1, 3), np.uint8)) is None and find(np.zeros((0, 0, 1), np.uint8)) is None
    y, x = np.mgrid[0:200, 0:200]
    disc = (np.where((x - 100) ** 2 + (y - 100) ** 2 < 6400, 220, 30)).astype(np.uint8)[..., None]
    assert 0.6 < find(disc)[0] < 0.7  # a circle's best quadrilateral is its square: 2 / pi
    spot = np.zeros((300, 300, 1), np.uint8)
    spot[10:30, 10:30] = 255
    assert find(spot) is None


def test_largest_quadrilateral_is_the_largest():
    rng = np.random.default_rng(3)
    for _ in range(30):
        own = corners.hull(rng.normal(size=(14, 2)))
        if len(own) >= 4:
            every = max(corners.area(own[[a, b, c, d]]) for a in range(len(own)) for b in range(a + 1, len(own)) for c in range(b + 1, len(own)) for d in range(c + 1, len(own)))
            assert abs(corners.area(corners.largest_quadrilateral(own)) - every) < 1e-9


def test_bent_edges_are_straightened():
    corner = [(60, 80), (320, 80), (320, 340), (60, 340)]
    px = drawn(corner, bow=14, noise=3)
    found = np.array(corner, float)
    left = images.dewarp(px, lambda _: (1.0, found), Dewarp(enable_strong_correction=False))[0]
    flat = images.dewarp(px, lambda _: (1.0, found), Dewarp())[0]
    middle = slice(150, 230)
    assert (left[4:12, middle] < 120).mean() > 0.9  # the ground shows above the sagging edge
    assert (flat[6:40, middle] > 180).mean() > 0.98 and (flat[-40:-6, middle] > 180).mean() > 0.98
    straight = drawn(corner, noise=3)
    assert [b.tolist() for b in corners.bends(straight, found, 12)] == [[0.0], [0.0]]


@pytest.mark.parametrize("tile", [7, 64, 1000])
def test_tiles_change_nothing(tile):
    rng = np.random.default_rng(1)
    px = rng.integers(0, 256, (90, 70, 3), dtype=np.uint8)
    source = images.dewarp_source((90, 70), np.array([[-5.5, 3], [66, -2], [75, 95], [4, 80]], float))
    y, x = np.mgrid[0:90, 0:70].astype(float)
    assert (images.remap(px, (90, 70), source, tile=tile) == images.bilinear(px, *source(x, y))).all()
    far = images.remap(px, (20, 20), lambda x, y: (x + 500, y), tile=tile)
    assert (far == 255).all()
    a, b = images.turn(px, 31), images.turn(images.turn(px, 31), -31)
    assert a.shape[0] == int(90 * math.cos(math.radians(31)) + 70 * math.sin(math.radians(31))) and b.shape[0] > a.shape[0]
