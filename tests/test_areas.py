"""Buffers, rasters, borders that neighbours share, and areas of interest, against points and distances."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dissolve import layer, regular
from test_rings import drawn, seen

from parcelight.functions import kernels, offset, planar
from parcelight.operators import arcs, areas, dissolve, rings, spatial

ELL = [[(0, 0), (10, 0), (10, 3), (3, 3), (3, 10), (0, 10)]]
RINGED = [[(20, 0), (30, 0), (30, 10), (20, 10)], [(24, 3), (24, 7), (27, 7), (27, 3)]]
DUMBBELL = [[(0, 20), (6, 20), (6, 22), (12, 22), (12, 20), (18, 20), (18, 26), (12, 26), (12, 23), (6, 23), (6, 26), (0, 26)]]


def gap(rings_, x, y):
    """Distance to the edges."""
    out = math.inf
    for r in rings_:
        for (ax, ay), (bx, by) in zip(r, [*r[1:], r[0]], strict=True):
            t = min(1, max(0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            out = min(out, math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)))
    return out


@pytest.mark.parametrize(("by", "at"), [(-1.3, 0.0), (-0.4, 0.0), (1.1, 0.0), (2.2, 0.0), (-1.3, 6_000_000.0)])
def test_buffers(spark, by, at):
    rnd = random.Random(4)
    shapes = [ELL, RINGED, DUMBBELL, [regular(40, 5, 4, 5, 0.3)], [[(60, 0), (62, 0), (62, 2), (60, 2)]], [[(70 + (3 if k % 2 else 8) * math.cos(k * math.pi / 6) * rnd.uniform(0.9, 1), (3 if k % 2 else 8) * math.sin(k * math.pi / 6)) for k in range(12)]]]
    moved = [[[(x + at, y + at) for x, y in r] for r in g] for g in shapes]
    out = {}
    for r in areas.buffered(layer(spark, moved), by).collect():
        out.setdefault(r["id"], []).append(r)
    for k, g in enumerate(moved):
        x0, y0, x1, y1 = planar.bounds(g)
        made = drawn(out.get(k, []))
        for _ in range(400):
            x, y = rnd.uniform(x0 - 3, x1 + 3), rnd.uniform(y0 - 3, y1 + 3)
            near, inside = gap(g, x, y), planar.contains_point(g, x, y)
            if abs(near - abs(by)) > 0.01:
                want = inside and near > -by if by < 0 else inside or near < by
                assert any(planar.contains_point(p, x, y) for p in made) == want, (k, x, y)
    parts = {k: len(v) for k, v in out.items()}
    assert (parts.get(2) == 2) == (by < -0.5) and (4 in parts) == (by > -1)
    assert (len(out[1][0]["rings"]) == 2) == (by < 1.5)


def test_pixels_of_polygons(spark):
    shapes = [ELL, RINGED, [regular(15.3, 14.7, 6, 7, 0.2)], [[(-5, -5), (3, -5), (3, 4)]], [[(28.2, 25), (40, 25), (40, 40)]]]
    out = areas.rasterised(layer(spark, shapes), 30, 31).collect()
    for k, g in enumerate(shapes):
        want = kernels.rasterise([g], 30, 31)
        mine = np.zeros((30, 31), int)
        for r in out:
            if r["id"] == k:
                mine[r["row"], r["col"]] += 1
        assert (mine == want).all()


def sheet(rnd, n, m):
    """Neighbours without gaps whose common sides are bent at several points."""
    at = lambda i, j: (20.0 * i + shift[i, j][0], 20.0 * j + shift[i, j][1])
    shift = {(i, j): (rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for i in range(n + 1) for j in range(m + 1)}
    sides = {}

    def side(a, b):
        if (b, a) in sides:
            return sides[b, a][::-1]
        if (a, b) not in sides:
            (ax, ay), (bx, by) = at(*a), at(*b)
            sides[a, b] = [(ax, ay)] + [(ax + (bx - ax) * t / 6 + rnd.uniform(-1, 1), ay + (by - ay) * t / 6 + rnd.uniform(-1, 1)) for t in range(1, 6)] + [(bx, by)]
        return sides[a, b]

    out = []
    for i in range(n):
        for j in range(m):
            corners = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
            out.append([[p for a, b in zip(corners, [*corners[1:], corners[0]], strict=True) for p in side(a, b)[:-1]]])
    return out


def overlap(spark, rows):
    """(sum of areas, area of the union) of polygons."""
    shapes = drawn(rows)
    flat = layer(spark, shapes).withColumn("component", F.lit(0))
    return sum(map(planar.area, shapes)), sum(r["area"] for r in rings.polygons(dissolve.outline(flat, 20.0)).collect())


def test_neighbours_stay_together(spark):
    whole = layer(spark, sheet(random.Random(2), 5, 4))
    before = sum(map(planar.area, drawn(whole.collect())))
    out = arcs.simplified(whole, 20.0, 1.2).collect()
    assert len(out) == 20 and max(sum(map(len, g)) for g in drawn(out)) < 20


def test_polygons_on_their_own_come_apart(spark):
    """A corner of two neighbours lies a little off a third one's straight side: only as a common point it stays."""
    third = [[(0, 0), (10, 0), (10.8, 10), (10, 20), (0, 20)]]
    rows = layer(spark, [third, [[(10, 0), (20, 0), (20, 10), (10.8, 10)]], [[(10.8, 10), (20, 10), (20, 20), (10, 20)]]])
    alone = sum(map(planar.area, drawn(spatial.simplified(rows, "rings", 1.0).collect())))
    out = arcs.simplified(rows, 10.0, 1.0).collect()
    total, union = overlap(spark, out)
    assert abs(alone - 392) < 1e-6 and abs(total - 400) < 1e-6 and abs(union - 400) < 1e-6


def test_borders_with_a_corner_on_one_side(spark):
    """A corner that lies on a neighbour's straight edge, islands in holes, two borders between the same corners, lone rings."""
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    shapes = [[box(0, 0, 10, 20)], [box(10, 0, 20, 10)], [box(10, 10, 20, 20)], [box(40, 0, 60, 20), box(45, 5, 55, 15)], [box(45, 5, 55, 15)], [regular(80, 10, 3, 40, 0.1)], [[(100, 0), (110, 0), (105, 0.2)]], [[(100, 0), (105, -0.2), (110, 0)]]]
    out = {r["id"]: drawn([r])[0] for r in arcs.simplified(layer(spark, shapes), 10.0, 0.5).collect()}
    assert set(out) == set(range(8)) and [len(g) for g in out.values() if len(g) > 1] == [2]
    assert all(abs(planar.area(out[k]) - planar.area(shapes[k])) < 1e-6 for k in (0, 1, 2, 3, 4))
    assert 3 <= len(out[5][0]) < 40 and planar.area(out[6]) > 0 and planar.area(out[7]) > 0
    kept = {r["id"]: len(r["rings"][0]) for r in arcs.simplified(layer(spark, shapes), 10.0, 0.5, max_count=40).collect()}
    assert kept[5] == 40
    assert arcs.simplified(layer(spark, shapes).where("false"), 10.0, 0.5).count() == 0


@pytest.mark.parametrize("few", [200_000, 3])
def test_areas_of_interest(spark, monkeypatch, few):
    monkeypatch.setattr(areas, "FEW_EDGES", few)
    rnd = random.Random(9)
    coast = [(50 + (30 + 12 * (k % 3)) * math.cos(k * math.pi / 40), 50 + (30 + 12 * (k % 3)) * math.sin(k * math.pi / 40)) for k in range(80)]
    area = [[coast, regular(50, 50, 9, 6, 0.1)[::-1]], [regular(120, 50, 9, 5, 0)], *[[regular(8 + 20 * k, 99, 0.3, 4, 0)] for k in range(6)]]
    shapes = [[regular(rnd.uniform(0, 130), rnd.uniform(0, 100), rnd.uniform(0.5, 6), rnd.choice([3, 4, 5]), rnd.uniform(0, 6))] for _ in range(300)]
    shapes += [area[1], [regular(50, 50, 12, 8, 0)], [regular(50, 50, 95, 30, 0)], [regular(50, 50, 3, 4, 0)]]
    rows = layer(spark, shapes)
    apart, hit = areas.split_by_area(rows, layer(spark, area), 8.0)
    touched = {r["id"] for r in hit.collect()}
    assert touched == {k for k, g in enumerate(shapes) if any(planar.intersects(a, g) for a in area)}
    assert {r["id"] for r in apart.collect()} == set(range(len(shapes))) - touched
    inside = {r["id"] for r in areas.contained_in(rows, layer(spark, area), 8.0).collect()}
    grid = {k: [p for a, b in zip(g[0], [*g[0][1:], g[0][0]], strict=True) for p in [((1 - t) * a[0] + t * b[0], (1 - t) * a[1] + t * b[1]) for t in np.linspace(0.001, 0.999, 40)]] for k, g in enumerate(shapes)}
    want = {k for k, g in enumerate(shapes) if k in touched and any(all(planar.contains_point(a, x, y) for x, y in grid[k]) and not any(planar.contains_point(g, *r[0]) for r in a) for a in area)} | {300}
    assert inside == want and len(inside) > 40 and 301 not in inside
    boxes = {r["id"] for r in spatial.split_by_box(rows, planar.bounds(area[0]))[1].collect()}
    assert boxes - touched and touched - boxes  # a box does not do
    assert areas.contained_in(rows, layer(spark, area).where("false"), 8.0).count() == 0


def test_zones_merge_after_reprojection(spark):
    """One zone's polygons in 32634, the other's in 32635; where they meet they become one, in 32634, and simpler."""
    from parcelight.operators import zones

    box = lambda x, y, w, h: [(x, y), (x + w / 2, y), (x + w, y), (x + w, y + h), (x, y + h)]
    x, y = 690_000.0, 6_100_000.0
    here = [[box(x, y, 100, 100)], [box(x + 500, y, 100, 100)], [box(x + 5000, y, 100, 100)], [box(x + 900, y, 900, 900)]]
    there = [planar.reproject([box(x + 50, y + 50, 100, 100)], 32634, 32635), planar.reproject([box(x + 700, y, 50, 50)], 32634, 32635), planar.reproject([box(x + 599.9, y + 99.9, 50, 50)], 32634, 32635)]
    overlap = layer(spark, [[box(x - 10, y - 10, 2000, 2000)]])
    for together in (False, True):
        out = zones.merged(layer(spark, here), layer(spark, there), (32634, 32635), 32634, 200.0, overlap, 100_000.0, 2.5, together).collect()
        got = sorted((r["source"], round(r["area"] / 100), sum(map(len, r["rings"]))) for r in out)
        assert [g[:2] for g in got] == [("alone", 25), ("apart", 100), ("merged", 125), ("merged", 175)]
        assert dict((g[0], g[2]) for g in got[:2]) == {"alone": 4, "apart": 4} and got[3][2] == 8
    everything = zones.merged(layer(spark, here), layer(spark, there), (32634, 32635), 32634, 200.0, tolerance=None)
    assert sorted(r["source"] for r in everything.collect()) == ["alone", "alone", "alone", "merged", "merged"]


def test_parcels_in_a_box(spark):
    from parcelight.sources import readers

    rows = layer(spark, [ELL, RINGED, [[(0, 9), (1, 8), (1, 10)]]])
    box = (4, 4, 9, 9)
    assert {r["id"] for r in readers.parcels_in(rows, box).collect()} == {0} and readers.parcels_in(rows, box, exact=True).count() == 0
    assert {r["id"] for r in readers.parcels_in(rows, (2, 2, 9, 9), exact=True).collect()} == {0}
    assert readers.parcels_in(rows, (25, 4, 26, 6), exact=True).count() == 0 and readers.parcels_in(rows, (25, 4, 26, 7), exact=True).count() == 1
    moved = spatial.reprojected(rows.unionByName(rows.limit(1).withColumn("rings", F.lit(None).cast(rows.schema["rings"].dataType))), "rings", 32634, 32634)
    assert sorted(map(str, moved.select("rings").collect())) == sorted(map(str, [*rows.select("rings").collect(), type(rows.first())("rings")(None)]))


def test_zones_of_tiles(spark):
    """Three tiles of each zone in a row, one of each in common: that one is the overlap, the others are the zones."""
    from parcelight.operators import zones

    box = lambda x: [[(x, 0), (x + 10, 0), (x + 10, 10), (x, 10)]]
    tiles = layer(spark, [box(0), box(10), box(20), box(20), box(30), box(40)]).withColumn("zone", F.floor(F.col("id") / 3).cast("int"))
    shared = zones.overlap(tiles.where("zone = 0"), tiles.where("zone = 1"), 10.0)
    assert abs(sum(map(planar.area, drawn(shared.collect()))) - 100) < 0.01
    hit, rest = zones.split(tiles, shared, "zone", 10.0, widen=0.001)
    assert {r["id"] for r in hit.collect()} == {2, 3}
    got = {r["zone"]: planar.bounds(g) for r, g in zip(rest.collect(), drawn(rest.collect()), strict=True)}
    assert np.allclose([got[0], got[1]], [(-0.001, -0.001, 20.001, 10.001), (29.999, -0.001, 50.001, 10.001)], atol=1e-5)


def test_shared_areas_without_tracing(spark, monkeypatch):
    rnd = random.Random(8)
    some = lambda n: layer(spark, [[regular(rnd.uniform(0, 30), rnd.uniform(0, 30), rnd.uniform(1, 6), rnd.randint(3, 9), rnd.random())] for _ in range(n)] + [ELL, RINGED, DUMBBELL])
    a, b = some(40), some(30)
    want = {(r["left_id"], r["right_id"]): r["area"] for r in areas.intersections(a, b, 4.0).groupBy("left_id", "right_id").agg(F.sum("area").alias("area")).collect()}
    monkeypatch.setattr(rings, "polygons", None)
    mine = {(r["left_id"], r["right_id"]): r["area"] for r in areas.shared_areas(a, b, 4.0).collect()}
    assert len(want) > 50 and mine == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("by", [-0.6, 0.7])
def test_pixels_of_buffers_without_tracing(spark, monkeypatch, by):
    shapes = [ELL, RINGED, DUMBBELL, [regular(15.3, 34.7, 6, 7, 0.2)], [[(-5, -5), (3, -5), (3, 4)]], [[(0, 12), (1, 12), (1, 13), (0, 13)]]]
    want = sorted(map(tuple, areas.rasterised(areas.buffered(layer(spark, shapes), by), 160, 120, 0.25).collect()))
    real = areas.closed
    monkeypatch.setattr(areas, "closed", lambda shape, ends, n: real(shape, ends, n) & (np.arange(n) != 1))  # one goes the longer way
    assert sorted(map(tuple, areas.rasterised_buffer(layer(spark, shapes), by, 160, 120, 0.25).collect())) == want
    monkeypatch.setattr(areas, "closed", real)
    monkeypatch.setattr(rings, "polygons", None)
    assert sorted(map(tuple, areas.rasterised_buffer(layer(spark, shapes), by, 160, 120, 0.25).collect())) == want


def test_segments_that_meet_are_found_a_portion_at_a_time(monkeypatch):
    e = np.random.default_rng(5).uniform(0, 40, (300, 4))
    e[:, 2:] = e[:, :2] + np.random.default_rng(6).uniform(-3, 3, (300, 2))
    e[0] = (0, 0, 40, 40)
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if (low[i] <= high[j]).all() and (low[j] <= high[i]).all()}
    monkeypatch.setattr(offset, "MANY", 64)
    i, j = offset.near_pairs(e)
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist(), strict=True)) == want
    most = [len(range(*s.indices(300))) for s in offset.portions(np.full(300, 10))]
    assert max(most) <= 8 and sum(most) == 300


@pytest.mark.parametrize("in_cell", [32, 2])
def test_a_large_area_meets_tiles_by_its_edges(spark, monkeypatch, in_cell):
    """no tile is joined with a whole area, and cells, corners and middle heights may all fall together."""

    def never(*_):
        raise AssertionError("a whole area is joined with every tile")

    monkeypatch.setattr(areas, "FEW_EDGES", 3)
    monkeypatch.setattr(areas, "box_join", never)
    monkeypatch.setattr(areas.outlines, "IN_CELL", in_cell)
    rnd = np.random.default_rng(3)
    ground = rnd.random((24, 24)) < 0.6
    edges = [(0, x, y, x + 1, y) if ground[x, y] else (0, x + 1, y, x, y) for x in range(24) for y in range(24) if y == 0 or ground[x, y] != ground[x, y - 1] if ground[x, y] or y]
    edges += [(0, x + 1, 24, x, 24) for x in range(24) if ground[x, 23]]
    edges += [(0, x, y + 1, x, y) if ground[x, y] else (0, x, y, x, y + 1) for x in range(24) for y in range(24) if x == 0 or ground[x, y] != ground[x - 1, y] if ground[x, y] or x]
    edges += [(0, 24, y, 24, y + 1) for y in range(24) if ground[23, y]]
    area = rings.cut(rings.polygons(spark.createDataFrame([(0, *map(float, e[1:])) for e in edges], "component int, ax double, ay double, bx double, by double")))
    near = np.pad(ground, 1)
    at = [(int(x), int(y)) for x, y in rnd.integers(-1, 25, (150, 2))]
    boxes = [(x, y, x + d, y + d) for x, y in at for d in (1.0, 0.5)] + [(x + 0.25, y + 0.5, x + 0.75, y + 0.75) for x, y in at]
    shapes = [[[(a, b), (c, b), (c, d), (a, d)]] for a, b, c, d in boxes]
    wanted = set()
    for k, (a, b, c, d) in enumerate(boxes):
        x, y = [(math.ceil(p) - 1, math.floor(q)) for p, q in ((a, c), (b, d))]  # cells that share a point
        if near[max(x[0] + 1, 0) : x[1] + 2, max(y[0] + 1, 0) : y[1] + 2].any():
            wanted.add(k)
    _, hit = areas.split_by_area(layer(spark, shapes), areas.boxed(area), 8.0)
    assert {r["id"] for r in hit.collect()} == wanted and 0 < len(wanted) < len(shapes)


def test_shared_areas_without_pairs_of_shapes(spark, monkeypatch):
    """no pair is made of shapes; polygons of upright and level edges and others share what they should."""

    def never(*_):
        raise AssertionError("pairs of shapes are joined")

    monkeypatch.setattr(areas, "box_join", never)
    moved = lambda g, x, y: [[(p + x, q + y) for p, q in r] for r in g]
    square, roof = [[(0, 0), (4, 0), (4, 4), (0, 4)]], [[(0, 0), (8, 0), (4, 4)]]
    a, b = layer(spark, [ELL, RINGED, moved(square, 100, 0)]), layer(spark, [ELL, moved(square, 2, 2), moved(square, 23, 2), moved(roof, 0, 0), moved(square, 10, 0), moved(square, 104, 4)])
    got = {(r["left_id"], r["right_id"]): r["area"] for r in areas.shared_areas(a, b, 4.0).collect()}
    assert got == pytest.approx({(0, 0): 51.0, (0, 1): 7.0, (0, 3): 15.0, (1, 2): 7.0}, abs=1e-6)
