"""Kernels against brute force and hand-computed arrays."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelight.functions import kernels, planar

BLOCK = np.zeros((5, 5), int)
BLOCK[1:4, 1:4] = 1
extents = st.integers(0, 2**30 - 1).map(lambda n: np.array([n >> k & 1 for k in range(30)]).reshape(5, 6))


def test_disk_sizes():
    assert len(kernels.disk(1)) == 5 and len(kernels.disk(2)) == 13


def test_boundary_by_hand():
    want = ["01110", "10001", "10001", "10001", "01110"]
    assert ["".join(map(str, r)) for r in kernels.boundary(BLOCK, 1)] == want


def test_distance_by_hand():
    d = kernels.distance(BLOCK)
    assert d[2, 2] == 2 and set(d[BLOCK > 0].tolist()) == {1.0, 2.0}
    assert kernels.normalised_distance(BLOCK)[1, 1] == 0.5


@settings(max_examples=60, deadline=None)
@given(extents)
def test_distance_brute_force(x):
    d = kernels.distance(x)
    out = np.argwhere(x == 0)
    for r, c in np.argwhere(x > 0):
        want = min((math.dist((r, c), o) for o in out), default=math.inf)
        assert d[r, c] == pytest.approx(want)


@settings(max_examples=60, deadline=None)
@given(extents)
def test_labels_brute_force(x):
    got = kernels.label(x)
    seen = np.zeros(x.shape, int)
    for r, c in np.argwhere(x > 0):
        if not seen[r, c]:
            todo, mark = [(r, c)], r * x.shape[1] + c + 1
            while todo:
                a, b = todo.pop()
                if 0 <= a < x.shape[0] and 0 <= b < x.shape[1] and x[a, b] and not seen[a, b]:
                    seen[a, b] = mark
                    todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    assert (got == seen).all()


@settings(max_examples=60, deadline=None)
@given(extents)
def test_contours_close_around_high_pixels(x):
    rings = kernels.contours(x.astype(float), 0.5, outside=0.0)
    y, c = np.mgrid[0:5, 0:6] + 0.5
    for r in range(5):
        for k in range(6):
            assert planar.contains_point(rings, c[r, k] + 1e-7, y[r, k] + 1e-7) == bool(x[r, k])


def test_bicubic_keeps_constants_and_size():
    assert np.allclose(kernels.bicubic(np.full((4, 5), 3.0), 2), 3.0)
    assert kernels.combine_upsample(BLOCK.astype(float), kernels.boundary(BLOCK, 1).astype(float)).shape == (20, 20)


def test_rasterise_inner_buffer():
    square = [[(1.0, 1.0), (7.0, 1.0), (7.0, 7.0), (1.0, 7.0)]]
    assert kernels.rasterise([square], 8, 8).sum() == 36
    assert kernels.rasterise([square], 8, 8, 1.0).sum() == 16


def test_utm_round_trip_and_known_point():
    x, y = planar.to_utm(21.0, 0.0, 32634)
    assert x == pytest.approx(500000, abs=1e-6) and y == pytest.approx(0, abs=1e-6)
    for lon, lat in ((23.5, 55.1), (18.2, -33.4), (24.0, 0.5)):
        epsg = 32634 if lat >= 0 else 32734
        assert planar.from_utm(*planar.to_utm(lon, lat, epsg), epsg) == pytest.approx((lon, lat), abs=1e-9)


def test_simplify_drops_points_on_lines():
    ring = [(0.0, 0.0), (5.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 10.0), (0.0, 10.0)]
    assert planar.simplify_ring(ring, 0.1) == [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]


def test_polygon_predicates():
    a = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]
    b = [[(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]]
    c = [[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 6.0)]]
    assert planar.intersects(a, b) and planar.contains(a, b) and not planar.contains(b, a) and not planar.intersects(a, c)
    assert planar.area(a + b) == 15 and planar.centroid(a[0]) == (2.0, 2.0)


def test_rings_are_simplified_together_as_one_by_one():
    rng = np.random.default_rng(3)
    rings = [rng.integers(0, 12, (n, 2)).astype(float) for n in (0, 1, 3, 4, 5, 8, 30, 0, 60, 4)] + [np.array([(0.0, 0), (5, 0), (10, 0), (10, 10), (5, 10), (0, 10), (0, 5)])]
    for tolerance in (0.0, 1.0, 2.5, 100.0):
        flat = np.concatenate(rings)
        kept = planar.kept_of_rings(flat[:, 0], flat[:, 1], np.array([len(r) for r in rings]), tolerance)
        for ring, keep in zip(rings, np.split(kept, np.cumsum([len(r) for r in rings])[:-1]), strict=True):
            points = [tuple(p) for p in ring.tolist()]
            assert [tuple(p) for p in ring[keep].tolist()] == planar.simplify_ring(points, tolerance)


def test_upsampling_takes_stacks_and_gives_blocks_alone():
    """many equal blocks are enlarged in one call, and only the part of a block without its halo."""
    x = np.random.default_rng(5).random((3, 11, 9))
    whole = np.stack([kernels.smooth_upsample(v) for v in x])
    assert np.allclose(kernels.smooth_upsample(x), whole, atol=1e-12)
    for i, j in ((0, 0), (4, 4), (8, 8)):
        assert np.allclose(kernels.smooth_upsample(x, block=(i, j, 4)), whole[:, 4 * i : 4 * i + 16, 4 * j : 4 * j + 16], atol=1e-12)
    assert np.array_equal(kernels.disk_max(x, 2), np.stack([kernels.disk_max(v, 2) for v in x]))
