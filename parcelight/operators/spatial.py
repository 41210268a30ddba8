"""Spatial joins: equi-joins on the cells of nested grids, refined on boxes and, where wanted, on the exact shapes.

Layers have box columns x0, y0, x1, y1. Each box belongs to the grid whose cells are as large as itself, so it lies in
four cells at most, however large it is, and cells of small boxes stay small, however dense they lie. Two boxes meet in
the grid of the larger one. A pair that shares several cells is kept only in the cell that holds the lower left corner of
the boxes' intersection, so no distinct is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import overlay, planar

BOX = ("x0", "y0", "x1", "y1")


#: The finest grid's cells are 2^FINEST times the unit.
FINEST = -30
#: Rows of a layer that may be sent to all executors in a join. Sizes are estimated from files, and know nothing of the
#: shapes that are made of their rows and of the cells in which each row comes.
FEW = 50_000


def level(cell: float, step: int = 1) -> Column:
    """The grid of a box: its cells are 2^level times cell, the least that is no smaller than the box (of every step-th)."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / cell
    return F.when(side > 2.0**FINEST, F.ceil(F.log2(side) / step).cast("int") * step).when(side.isNotNull(), F.lit(FINEST))


def cells(layer: DataFrame, cell: float, others: list[int], step: int = 1) -> DataFrame:
    """A layer with level, for each cell (grid, cx, cy) of its own grid and of the coarser ones of others."""
    own = F.col("level")
    grids = F.concat(F.array(own), F.filter(F.array(*[F.lit(n) for n in others]), lambda n: n > own))
    size = F.pow(F.lit(2.0), F.col("grid")) * cell
    span = lambda a, b: F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size))
    return layer.withColumn("level", level(cell, step)).withColumn("grid", F.explode(grids)).withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))


def overlap(a: str, b: str) -> Column:
    """Whether the boxes of two aliased layers share a point."""
    c = lambda t, n: F.col(f"{t}.{n}")
    return (c(a, "x0") <= c(b, "x1")) & (c(b, "x0") <= c(a, "x1")) & (c(a, "y0") <= c(b, "y1")) & (c(b, "y0") <= c(a, "y1"))


def box_join(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Pairs of rows whose boxes share a point: columns l (a struct of the left row) and r. cell is the unit of the grids;
    which one is chosen changes little. A box with a null meets none."""
    sides = left.select(level(cell).alias("n"), F.lit(True).alias("mine")).unionByName(right.select(level(cell).alias("n"), F.lit(False).alias("mine")))
    found = sides.where("n is not null").groupBy("n", "mine").count().collect()  # one for each power of two
    of = lambda mine: sorted(r["n"] for r in found if r["mine"] == mine)
    if not of(True) or not of(False):
        left, right = left.where("false"), right.where("false")
    a, b = cells(left, cell, of(False) or [0]).alias("a"), cells(right, cell, of(True) or [0]).alias("b")
    rows = lambda mine: sum(r["count"] for r in found if r["mine"] == mine)
    if min(rows(True), rows(False)) > FEW:
        a, b = a.hint("merge"), b.hint("merge")
    size = F.pow(F.lit(2.0), F.col("a.grid")) * cell
    home = (F.floor(F.greatest("a.x0", "b.x0") / size) == F.col("a.cx")) & (F.floor(F.greatest("a.y0", "b.y0") / size) == F.col("a.cy"))
    same = (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    met = a.join(b, same & (F.col("a.grid") == F.greatest("a.level", "b.level")) & overlap("a", "b") & home)
    return met.select(F.struct(*[F.col(f"a.{c}") for c in left.columns]).alias("l"), F.struct(*[F.col(f"b.{c}") for c in right.columns]).alias("r"))


def exact(pairs: DataFrame, test: str = "share_point") -> DataFrame:
    """Of pairs whose structs have rings, those that share a point (or of which the left covers the right one)."""
    check = getattr(overlay, test)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = (overlay.edges_of(b.column(b.schema.get_field_index(c)).field("rings")) for c in ("l", "r"))
            yield b.filter(pa.array(check(overlay.Pairs(left, right, b.num_rows))))

    return pairs.mapInArrow(run, pairs.schema)


def remainder(layer: DataFrame, pairs: DataFrame, side: str, key: str = "id") -> DataFrame:
    """Rows of a layer that are in no pair."""
    return layer.join(pairs.select(F.col(f"{side}.{key}").alias(key)).distinct(), key, "left_anti")


def split_by_box(layer: DataFrame, box: tuple[float, float, float, float]) -> tuple[DataFrame, DataFrame]:
    """(rows apart from the box, rows that share a point with it)."""
    x0, y0, x1, y1 = box
    hit = (F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0)
    return layer.where(~hit), layer.where(hit)


def contained(layer: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose box lies in the given one."""
    x0, y0, x1, y1 = box
    return layer.where((F.col("x0") >= x0) & (F.col("x1") <= x1) & (F.col("y0") >= y0) & (F.col("y1") <= y1))


def first_match(pairs: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """For each left key the value of the matching right row that comes first."""
    return pairs.groupBy(F.col(f"l.{key}").alias(key)).agg(F.min_by(F.col(f"r.{value}"), F.col(f"r.{order}")).alias(value))


def total_bounds(layer: DataFrame, *keys: str) -> DataFrame:
    return layer.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def bounds_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """The box that the bounds of two layers share (one row, inverted if there is none)."""
    both = total_bounds(a).unionByName(total_bounds(b))
    return both.agg(F.max("x0").alias("x0"), F.max("y0").alias("y0"), F.min("x1").alias("x1"), F.min("y1").alias("y1"))


def rectangle_rings(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box as rings."""
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1)))


def ring_area(ring: Column) -> Column:
    """Area of a ring by the shoelace formula, without a UDF."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.abs(F.aggregate(F.zip_with(ring, following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda s, v: s + v)) / 2


def area(rings: Column) -> Column:
    """Area of a polygon: the exterior less its holes."""
    holes = F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0)))
    return ring_area(F.element_at(rings, 1)) - F.aggregate(F.transform(holes, ring_area), F.lit(0.0), lambda s, v: s + v)


def perimeter(rings: Column) -> Column:
    """Length of all rings."""

    def length(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        return F.aggregate(F.zip_with(ring, following, lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"])), F.lit(0.0), lambda s, v: s + v)

    return F.aggregate(F.transform(rings, length), F.lit(0.0), lambda s, v: s + v)


def vertex_count(rings: Column) -> Column:
    return F.aggregate(F.transform(rings, F.size), F.lit(0), lambda s, n: s + n)


def bounding_box(rings: Column) -> Column:
    points = F.flatten(rings)
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def under_area(layer: DataFrame, rings: str, most: float | None) -> DataFrame:
    """Polygons under an area; all of them without a limit. Empty ones and those without an area go."""
    out = layer.where(F.col(rings).isNotNull() & (F.size(rings) > 0)).withColumn("area", area(F.col(rings))).where(F.col("area").isNotNull())
    return out if most is None else out.where(F.col("area") < most)


def shapes(layer: DataFrame, rings: str, change) -> DataFrame:
    """A layer with each polygon replaced by change(rings): simplification or reprojection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(rings)
            made = [None if g is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in change([[(p["x"], p["y"]) for p in ring] for ring in g])] for g in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(made, b.schema.field(at).type))

    return layer.mapInArrow(run, layer.schema)


def simplified(layer: DataFrame, rings: str, tolerance: float = 2.5, max_count: int | None = None) -> DataFrame:
    """Polygons simplified; with max_count only those with more exterior vertices. All rings of a batch at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(rings)
            column = b.column(at)
            parts = column.flatten()
            points = parts.flatten()
            n, size = (np.asarray(v.value_lengths().fill_null(0)).astype(np.int64) for v in (column, parts))
            x, y = (np.asarray(points.field(k), float) for k in (0, 1))
            keep = planar.kept_of_rings(x, y, size, tolerance)
            if max_count is not None:
                first = np.zeros(len(n), np.int64)
                first[n > 0] = size[(np.cumsum(n) - n)[n > 0]]
                keep |= np.repeat(np.repeat(first <= max_count, n), size)
            left = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], np.cumsum(size)))]
            made = overlay.lists(parts, np.diff(left), pa.StructArray.from_arrays([pa.array(v[keep]) for v in (x, y)], names=["x", "y"]))
            yield b.set_column(at, b.schema.field(at), overlay.lists(column, n, made).cast(column.type))

    return layer.mapInArrow(run, layer.schema)


def reprojected(layer: DataFrame, rings: str, source: int, target: int) -> DataFrame:
    """A layer in another reference system: all points of a batch at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(rings)
            points = b.column(at).flatten().flatten()
            x, y = planar.moved(*(np.asarray(points.field(k), float) for k in (0, 1)), source, target)
            yield b.set_column(at, b.schema.field(at), overlay.with_points(b.column(at), x, y))

    return layer.mapInArrow(run, layer.schema)


def rasterised_boxes(layer: DataFrame, height: int, width: int, buffer: int = 0) -> DataFrame:
    """Pixels (row, col) whose unit square lies in a box shrunk by buffer, clipped to the raster: each once."""
    span = lambda a, b, n: F.sequence(F.greatest(F.col(a) + buffer, F.lit(0)), F.least(F.col(b) - buffer, F.lit(n)) - 1)
    some = (F.least(F.col("x1") - buffer, F.lit(width)) > F.greatest(F.col("x0") + buffer, F.lit(0))) & (F.least(F.col("y1") - buffer, F.lit(height)) > F.greatest(F.col("y0") + buffer, F.lit(0)))
    return layer.where(some).withColumn("col", F.explode(span("x0", "x1", width))).withColumn("row", F.explode(span("y0", "y1", height)))


def zone_overlap(grid: DataFrame, zone: str, shrink: float = 1e-4) -> tuple[float, float, float, float] | None:
    """The box that the bounds of all zones of a grid share, a little smaller; None if there is none."""
    per_zone = total_bounds(grid, zone)
    b = per_zone.agg(F.max("x0").alias("x0"), F.max("y0").alias("y0"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.count(F.lit(1)).alias("n")).first()
    if not b["n"]:
        return None
    box = (b["x0"] + shrink, b["y0"] + shrink, b["x1"] - shrink, b["y1"] - shrink)
    return box if box[0] <= box[2] and box[1] <= box[3] else None


def overlap_tiles(grid: DataFrame, zone: str) -> DataFrame:
    """Grid tiles with in_overlap: whether they meet what the zones share."""
    box = zone_overlap(grid, zone)
    if box is None:
        return grid.withColumn("in_overlap", F.lit(False))
    apart, hit = split_by_box(grid, box)
    return apart.withColumn("in_overlap", F.lit(False)).unionByName(hit.withColumn("in_overlap", F.lit(True)))


def box_centre_distance(x: float, y: float) -> Column:
    """Distance of a box's centre to a point."""
    return F.hypot((F.col("x0") + F.col("x1")) / 2 - x, (F.col("y0") + F.col("y1")) / 2 - y)
