"""Crowds of shapes: as many rows as shapes where all meet, and what all pairs would give."""

import random

import pytest
from pyspark.sql import functions as F

from parcelight.functions import planar
from parcelight.operators import crowds, dissolve, spatial

BOX = "id long, x0 double, y0 double, x1 double, y1 double"


def crowd(n, spread, sizes, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        x, y, s = rnd.uniform(-spread, spread), rnd.uniform(-spread, spread), rnd.choice(sizes)
        out.append((i, x, y, x + rnd.uniform(0, s), y + rnd.uniform(0, s)))
    return out


def touch(a, b):
    return a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]


def roots(rows, linked):
    root = {r[0]: r[0] for r in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in rows:
        for b in rows:
            if a[0] < b[0] and linked(a, b):
                p, q = sorted((find(a[0]), find(b[0])))
                root[q] = p
    return {k: find(k) for k in root}


@pytest.mark.parametrize(("n", "spread", "zoned"), [(250, 40, False), (250, 6, False), (250, 12, True)])
def test_components_of_all_pairs(spark, n, spread, zoned):
    rows = [*crowd(n, spread, [0.01, 1, 1, 30], n + spread), (1000, -1e6, 90.0, 1e6, 91.0), (1001, 3.0, 3.0, 3.0, 3.0), (1002, 8.0, 0.0, 16.0, 8.0), (1003, 16.0, 8.0, 20.0, 9.0)]
    layer = spark.createDataFrame(rows, BOX).withColumn("zone", F.col("id") % 2)
    edges = crowds.forest(layer, 5.0, zone="zone" if zoned else None)
    found = {r["id"]: r["component"] for r in dissolve.connected(layer, edges).collect()}
    assert found == roots(rows, lambda a, b: touch(a, b) and (not zoned or a[0] % 2 != b[0] % 2))


def test_a_crowd_has_few_edges(spark):
    layer = spark.createDataFrame(crowd(3000, 1, [1], 3), BOX)
    assert dissolve.overlap_edges(layer, 1.0).count() < 30 * 3000  # 1,000,000 pairs and more meet
    assert dissolve.dissolve_boxes(layer, 1.0).count() < 10


def test_first_of_those_that_meet(spark):
    rows = crowd(300, 10, [0.01, 1, 9], 4)
    left, right = rows[:150], rows[150:]
    a, b = spark.createDataFrame(left, BOX), spark.createDataFrame(right, BOX).withColumn("v", F.col("id") * 10)
    want = {p[0]: min(q[0] for q in right if touch(p, q)) * 10 for p in left if any(touch(p, q) for q in right)}
    assert {r["id"]: r["v"] for r in crowds.first_met(a, b, 3.0, "id", "id", "v").collect()} == want
    assert {r["id"] for r in crowds.first_met(a, b, 3.0).collect()} == set(want)
    assert crowds.first_met(a, b.where("false"), 3.0).count() == 0
    assert "Join" not in crowds.first_met(a, b, 3.0)._jdf.queryExecution().toString()


def test_union_of_a_crowd(spark):
    """Rectangles of whole numbers in a few places, many of them equal or side by side, with one around and one far."""
    rnd = random.Random(8)
    rects = [(x, y, x + rnd.randint(1, 6), y + rnd.randint(1, 4)) for _ in range(300) for x, y in [(rnd.randint(-12, 12), rnd.randint(-12, 12))]]
    rects += [(-40, -2, 40, 1), (100, 100, 101, 101), (100, 101, 101, 102), *rects[:3]]
    rows = [(k, *map(float, r), [[{"x": float(x), "y": float(y)} for x, y in ((r[0], r[1]), (r[2], r[1]), (r[2], r[3]), (r[0], r[3]))]]) for k, r in enumerate(rects)]
    layer = spark.createDataFrame(rows, BOX + ", rings array<array<struct<x:double,y:double>>>").withColumn("component", F.lit(0))
    edges = dissolve.outline(layer, 4.0)
    assert "Join" not in edges._jdf.queryExecution().toString()  # no pairs of polygons
    cells = {(x, y) for r in rects for x in range(r[0], r[2]) for y in range(r[1], r[3])}
    free = sum((x + i, y + j) not in cells for x, y in cells for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1)))
    got = dissolve.measures(edges).first()
    assert abs(got["area"] - len(cells)) < 1e-6 and abs(got["perimeter"] - free) < 1e-6


def test_shapes_that_meet(spark):
    """Boxes of triangles meet where they do not."""
    rnd = random.Random(2)
    shapes = [[[(x, y), (x + rnd.uniform(0.2, 2), y), (x, y + rnd.uniform(0.2, 2))]] for _ in range(120) for x, y in [(rnd.uniform(0, 9), rnd.uniform(0, 9))]]
    rows = [(k, *map(float, planar.bounds(g)), [[{"x": float(x), "y": float(y)} for x, y in r] for r in g]) for k, g in enumerate(shapes)]
    layer = spark.createDataFrame(rows, BOX + ", rings array<array<struct<x:double,y:double>>>")
    found = {r["id"]: r["component"] for r in dissolve.connected(layer, crowds.forest(layer, 2.0, shaped=True)).collect()}
    assert found == roots(rows, lambda a, b: planar.intersects(shapes[a[0]], shapes[b[0]]))
    assert spatial.exact(spatial.box_join(layer, layer, 2.0)).count() > crowds.forest(layer, 2.0, shaped=True).count()


SHAPED = "id long, x0 double, y0 double, x1 double, y1 double, rings array<array<struct<x: double, y: double>>>"


def polygon(rnd, k):
    """Boxes, ells, boxes with a hole, boxes with a spike and triangles, on whole numbers so that many only touch."""
    x, y, w, h = rnd.randrange(40), rnd.randrange(40), rnd.randrange(2, 9), rnd.randrange(2, 9)
    box = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    if k % 5 == 1:
        rings = [[(x, y), (x + w, y), (x + w, y + 1), (x + 1, y + 1), (x + 1, y + h), (x, y + h)]]
    elif k % 5 == 2:
        rings = [box, [(x + 0.5, y + 0.5), (x + w - 0.5, y + 0.5), (x + w - 0.5, y + h - 0.5), (x + 0.5, y + h - 0.5)]]
    elif k % 5 == 3:
        rings = [[*box[:2], (x + w, y + 1), (x + w + 4, y + 1), (x + w, y + 1), *box[2:]]]
    else:
        rings = [box[:3]] if k % 5 == 4 else [box]
    xs, ys = zip(*rings[0], strict=True)
    return (k, float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys)), [[{"x": float(a), "y": float(b)} for a, b in r] for r in rings])


@pytest.mark.parametrize("block", [1 << 13, 7])
def test_pairs_in_cells_are_all_pairs(spark, block, monkeypatch):
    """As the join of pairs and its check edge by edge give them, also where cells are cut into blocks; in as many tasks as
    wanted, however small the input is."""
    monkeypatch.setattr(crowds, "BLOCK", block)
    rnd = random.Random(block)
    left = spark.createDataFrame([polygon(rnd, k) for k in range(150)] + [(900, None, 0.0, 1.0, 1.0, None)], SHAPED)
    right = spark.createDataFrame([polygon(rnd, k) for k in range(1000, 1150)], SHAPED)
    met = spatial.box_join(left, right, 4.0)
    for shaped, want in ((False, met), (True, spatial.exact(met))):
        made = crowds.pairs(left, right, 4.0, shaped=shaped)
        got = sorted(tuple(r) for r in made.collect())
        assert got == sorted(tuple(r) for r in want.select("l.id", "r.id").collect())
        assert made.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert crowds.pairs(left, right.where("false"), 4.0, shaped=True).count() == 0
