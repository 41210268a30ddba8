"""Ring assembly by joins, contours over blocks, and overlays against points of a fine raster."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dissolve import layer, regular

from parcelight.functions import kernels, planar
from parcelight.operators import areas, dissolve, focal, rings, spatial, vectorise

EDGE = "component string, ax double, ay double, bx double, by double"


def edges(spark, shapes):
    return spark.createDataFrame([(c, *map(float, a), *map(float, b)) for c, g in shapes for a, b in planar.directed_edges(g)], EDGE)


def drawn(rows):
    return [[[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in rows]


@pytest.mark.parametrize("block", [2, 5, 1 << 16])
def test_rings_over_blocks(spark, block):
    """A ring of 300 corners with a hole, in blocks of a few edges each; no group holds it."""
    star = [(1000 + (500 + 40 * (k % 2)) * math.cos(k * math.pi / 150), 1000 + (500 + 40 * (k % 2)) * math.sin(k * math.pi / 150)) for k in range(300)]
    hole = regular(1000, 1000, 100, 7, 0.3)
    small = [regular(3000 + 50 * k, 10, 5, 3 + k % 4, 0.1 * k) for k in range(20)]
    out = rings.polygons(edges(spark, [("a", [star, hole]), *[("b", [r]) for r in small]]), block=block).collect()
    assert sorted((r["component"], [len(g) for g in r["rings"]]) for r in out) == sorted([("a", [300, 7]), *[("b", [len(r)]) for r in small]])
    assert all(abs(r["area"] - planar.area(g)) < 1e-3 for r, g in zip(out, drawn(out), strict=True))
    pieces = rings.pieces(rings.linked(rings.snapped(edges(spark, [("a", [star, hole])]))), block)
    assert pieces.agg(F.max(F.size("edges"))).first()[0] <= block and (block > 300 or pieces.count() > 60)


def test_rings_that_touch_themselves(spark):
    """Two squares that meet in a corner are two parts; a hole that touches its exterior is a hole; straight points go."""
    squares = [(0, 0), (1, 0), (1, 1), (2, 1), (2, 2), (1, 2), (1, 1), (0, 1)]
    holed = [(0, 0), (2, 0), (4, 0), (4, 4), (0, 4), (0, 2), (1, 3), (1, 1), (0, 2)]
    out = {c: [] for c in "st"}
    for r in rings.polygons(edges(spark, [("s", [squares]), ("t", [holed])])).collect():
        out[r["component"]].append([len(g) for g in r["rings"]])
    assert out == {"s": [[4], [4]], "t": [[4, 3]]}


def test_holes_of_several_exteriors(spark):
    """Nested and neighbouring exteriors of one component: each hole goes to the least exterior around it."""
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    shapes = [[box(0, 0, 100, 100), box(10, 10, 90, 90)], [box(20, 20, 80, 80), box(30, 30, 40, 40), box(50, 50, 60, 60)], [box(32, 32, 38, 38)], [box(200, 0, 210, 10), box(203, 3, 204, 4)]]
    out = rings.polygons(edges(spark, [("x", g) for g in shapes])).collect()
    assert sorted(sorted(map(planar.area, ([r] for r in g)), reverse=True) for g in drawn(out)) == sorted(sorted((planar.area([r]) for r in g), reverse=True) for g in shapes)


def test_no_edges_and_open_ones(spark):
    assert rings.polygons(spark.createDataFrame([], EDGE)).count() == 0
    open_ = spark.createDataFrame([("o", 0.0, 0.0, 1.0, 0.0), ("o", 1.0, 0.0, 1.0, 1.0), (None, 0.0, 0.0, 1.0, 0.0), (None, 1.0, 0.0, 0.0, 1.0), (None, 0.0, 1.0, 0.0, 0.0)], EDGE)
    (one,) = rings.polygons(open_).collect()
    assert one["component"] is None and one["area"] == 0.5


@pytest.mark.parametrize("size", [3, 7, 64])
def test_contours_do_not_depend_on_blocks(spark, size):
    rnd = np.random.default_rng(3)
    images = [rnd.random((13, 17)), rnd.random((5, 5)).round(), np.ones((4, 9)), np.zeros((4, 4))]
    rows = [(k, *x.shape, x.ravel().tolist()) for k, x in enumerate(images)]
    tiles = spark.createDataFrame(rows, "img long, h int, w int, px array<double>")
    out = vectorise.parcels(focal.blocks(tiles, ["img"], size, 1), "img", 0.45, size).collect()
    for k, x in enumerate(images):
        want = kernels.contours(x, 0.45)
        own = [r for r in out if r["img"] == k]
        assert sum(len(r["rings"]) for r in own) == len(want)
        assert abs(sum(r["area"] for r in own) - sum(map(planar.ring_area, want))) < 1e-4
        for g in drawn(own):
            assert planar.ring_area(g[0]) > 0 and all(planar.ring_area(h) < 0 for h in g[1:])


def seen(shapes, grid):
    return np.array([[any(planar.contains_point(g, x, y) for g in shapes) for x in grid] for y in grid])


@pytest.mark.parametrize("at", [0.0, 6_000_000.0])
def test_overlays_of_turned_polygons(spark, at):
    rnd = random.Random(11)
    some = lambda n: [[[(x + at, y + at) for x, y in regular(rnd.uniform(0, 8), rnd.uniform(0, 8), rnd.uniform(0.7, 2), rnd.choice([3, 4, 6]), rnd.uniform(0, 6))]] for _ in range(n)]
    left, right = some(12), some(12)
    left.append([[(x + at, y + at) for x, y in ring] for ring in ([(-1, -1), (9, -1), (9, 9), (-1, 9)], [(3, 3), (3, 6), (6, 6), (6, 3)])])
    right.append(left[0])
    a, b = layer(spark, left), layer(spark, right)
    grid = np.arange(-2, 11, 0.13) + 0.0123 + at
    inside = {"l": [seen([g], grid) for g in left], "r": [seen([g], grid) for g in right]}
    shared = {}
    for r in areas.intersections(a, b, 2.0).collect():
        shared[r["left_id"], r["right_id"]] = shared.get((r["left_id"], r["right_id"]), 0) + r["area"]
    for i, p in enumerate(inside["l"]):
        for j, q in enumerate(inside["r"]):
            n = (p & q).sum() * 0.13**2
            assert abs(n - shared.get((i, j), 0)) < 0.3 + 0.04 * n, (i, j)
    less = {}
    for r in areas.difference(a, b, 2.0).collect():
        less.setdefault(r["id"], []).append(r)
    union = np.logical_or.reduce(inside["r"])
    assert 0 not in less  # one of the right ones is equal
    for i, p in enumerate(inside["l"]):
        assert (seen(drawn(less.get(i, [])), grid) != (p & ~union)).sum() <= 3
    whole = areas.shared(a, b, 2.0).collect()
    want = np.logical_or.reduce(inside["l"]) & union
    assert (seen(drawn(whole), grid) != want).sum() <= 6


def test_exact_predicates(spark):
    ell = [[(0, 0), (10, 0), (10, 2), (2, 2), (2, 10), (0, 10)]]
    others = [[[(4, 4), (6, 4), (6, 6), (4, 6)]], [[(2, 2), (3, 3), (2, 3)]], [[(1, 1), (2, 1), (2, 2), (1, 2)]], [[(0, 0), (2, 0), (2, 5), (0, 5)]], [[(1, 1), (3, 1), (3, 3)]], [[(0, 0), (10, 0), (10, 10), (0, 10)]]]
    pairs = spatial.box_join(layer(spark, [ell]), layer(spark, others), 4.0)
    found = lambda test: sorted(r[0] for r in spatial.exact(pairs, test).select("r.id").collect())
    assert found("share_point") == [1, 2, 3, 4, 5] and found("covers") == [2, 3]
    ringed = [[(0, 0), (9, 0), (9, 9), (0, 9)], [(3, 3), (3, 6), (6, 6), (6, 3)]]
    pairs = spatial.box_join(layer(spark, [ringed]), layer(spark, [[[(4, 4), (5, 4), (5, 5)]], [[(3, 3), (6, 3), (6, 6), (3, 6)]], [[(2, 2), (7, 2), (7, 7), (2, 7)]], [[(1, 1), (2, 1), (2, 2)]]]), 4.0)
    assert found("share_point") == [1, 2, 3] and found("covers") == [3]


def test_touching_parts_count_apart(spark):
    """The limit on areas holds for each polygon of a union, not for all that is connected through points."""
    box = lambda a, b, c, d: [[(a, b), (c, b), (c, d), (a, d)]]
    shapes = layer(spark, [box(0, 0, 3, 3), box(3, 3, 6, 6), box(20, 0, 23, 3), box(22, 0, 26, 3)]).withColumn("zone", (F.col("id") % 2).cast("int"))
    out = dissolve.merge_zone_shapes(shapes, "zone", 4.0, 10.0)
    assert sorted((r["component"], r["area"]) for r in out.collect()) == [(0, 9.0), (0, 9.0)]
