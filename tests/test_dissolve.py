"""Unions of polygons against a fine raster of points."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from parcelight.functions import planar
from parcelight.operators import dissolve, rings, spatial


def regular(x, y, r, n, turn):
    return [(x + r * math.cos(turn + 2 * math.pi * k / n), y + r * math.sin(turn + 2 * math.pi * k / n)) for k in range(n)]


def layer(spark, shapes):
    rows = [(k, *map(float, planar.bounds(g)), [[{"x": float(x), "y": float(y)} for x, y in r] for r in g]) for k, g in enumerate(shapes)]
    return spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double, rings array<array<struct<x:double,y:double>>>")


def test_union_of_turned_polygons(spark):
    rnd = random.Random(5)
    shapes = [[regular(rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.uniform(0.4, 1.5), rnd.choice([3, 4, 5, 7]), rnd.uniform(0, 6))] for _ in range(30)]
    shapes += [shapes[0], [shapes[1][0][::-1]]]
    members, edges = dissolve.dissolve(layer(spark, shapes), 2.0)
    part = {r["id"]: r["component"] for r in members.collect()}
    for p in range(len(shapes)):
        for q in range(p):
            assert not planar.intersects(shapes[p], shapes[q]) or part[p] == part[q]
    area = {r["component"]: r["area"] for r in dissolve.measures(edges).collect()}
    step = 0.15
    grid = np.arange(-2, 12, step) + 0.0123
    for c in set(part.values()):
        own = [shapes[k] for k in part if part[k] == c]
        seen = sum(any(planar.contains_point(g, x, y) for g in own) for x in grid for y in grid)
        assert abs(seen * step * step - area[c]) < 0.05 * area[c] + 0.2
    drawn = rings.polygons(edges).groupBy("component").agg(F.sum(spatial.area(F.col("rings"))).alias("area")).collect()
    assert {r["component"] for r in drawn} == set(area)
    assert all(abs(r["area"] - area[r["component"]]) < 1e-4 for r in drawn)


def test_shared_edges_holes_and_shapes_inside(spark):
    box = lambda a, b, c, d: [[(a, b), (c, b), (c, d), (a, d)]]
    frame = [box(0, 0, 5, 1), box(0, 4, 5, 5), box(0, 0, 1, 5), box(4, 0, 5, 5)]
    shapes = [*frame, box(2, 2, 3, 3), box(10, 0, 11, 1), box(11, 0, 12, 1), box(20, 0, 30, 10), box(22, 2, 23, 3), box(40, 0, 41, 1), box(41, 1, 42, 2)]
    _, edges = dissolve.dissolve(layer(spark, shapes), 4.0)
    out = {r["component"]: r for r in dissolve.measures(edges).collect()}
    assert {k: (r["area"], r["perimeter"]) for k, r in out.items()} == {0: (16.0, 32.0), 4: (1.0, 4.0), 5: (2.0, 6.0), 7: (100.0, 40.0), 9: (2.0, 8.0)}
    drawn = rings.polygons(edges).collect()
    assert {(r["component"], r["part"]): [len(g) for g in r["rings"]] for r in drawn} == {(0, 0): [4, 4], (4, 0): [4], (5, 0): [4], (7, 0): [4], (9, 0): [4], (9, 1): [4]}


def test_no_shapes(spark):
    empty = layer(spark, [[[(0, 0), (1, 0), (1, 1)]]]).where("false")
    members, edges = dissolve.dissolve(empty, 1.0)
    assert members.count() == 0 and rings.polygons(edges).count() == 0
