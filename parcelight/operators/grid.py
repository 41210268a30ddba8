"""Grids over an area: the tiles that meet it, those at its border clipped, in one reference system or zone by zone."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import planar
from . import areas, rings
from .spatial import BOX, rectangle_rings

#: The part of the earth that UTM zones cover, in degrees of latitude, and a zone's width (fixed values).
SOUTH, NORTH, ZONE = -80.0, 84.0, 6.0


def tiles(area: DataFrame, size: float) -> DataFrame:
    """tile_row, tile_col, x0, y0, x1, y1, area, whole, rings: squares of a grid that share ground with an area, and what they
    share (a row for each single polygon; rings is the square itself where the area covers it whole).

    area: box and rings of polygons that do not overlap. The grid begins at 0, 0. Squares within are found by their edges
    alone; only those at the border are overlaid. A square that only touches the area has no row.
    """
    span = lambda a, b: F.sequence(F.floor(F.col(a) / size).cast("int"), F.floor(F.col(b) / size).cast("int"))
    some = area.where("size(rings) > 0").select(F.explode(span("y0", "y1")).alias("tile_row"), *BOX)
    found = some.withColumn("tile_col", F.explode(span("x0", "x1"))).select("tile_row", "tile_col").distinct()
    at = lambda c, k: (F.col(c) + k) * F.lit(float(size))
    squares = found.withColumns({"x0": at("tile_col", 0), "y0": at("tile_row", 0), "x1": at("tile_col", 1), "y1": at("tile_row", 1)})
    squares = rings.cut(squares.withColumn("rings", rectangle_rings(*(F.col(c) for c in BOX))).withColumn("id", F.struct("tile_row", "tile_col")))
    inside = rings.cut(areas.against(squares, area, size, "covers"))
    within = squares.join(inside, "id", "left_semi").select("tile_row", "tile_col", *BOX, F.lit(float(size) ** 2).alias("area"), F.lit(True).alias("whole"), "rings")
    border = squares.join(inside, "id", "left_anti")
    named = area.where("size(rings) > 0").select(F.xxhash64("rings").alias("id"), *BOX, "rings")
    clipped = areas.intersections(border, named, size).select("left_id.*", "area", F.lit(False).alias("whole"), "rings")
    return within.unionByName(clipped.join(squares.drop("rings", "id"), ["tile_row", "tile_col"]).select("tile_row", "tile_col", *BOX, "area", "whole", "rings"))


def dense(ring: planar.Ring, step: float) -> planar.Ring:
    """A ring with a point every step at least, so that its edges can be bent."""
    out = []
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], *ring[:1]], strict=True):
        n = max(1, int(np.ceil(np.hypot(bx - ax, by - ay) / step)))
        out += [(ax + (bx - ax) * k / n, ay + (by - ay) * k / n) for k in range(n)]
    return out


def by_zone(area: DataFrame, step: float = 0.25) -> DataFrame:
    """epsg, box, rings: an area in degrees (box, rings) cut at the borders of UTM zones and at the equator, each piece in
    its zone's metres. Edges get a point every step degrees first."""
    shaped = area.where("size(rings) > 0").select(F.xxhash64("rings").alias("id"), *BOX, "rings")
    zones = shaped.select(F.explode(F.sequence(F.floor((F.col("x0") + 180) / ZONE).cast("int"), F.floor((F.col("x1") + 180) / ZONE).cast("int"))).alias("n"), "y0", "y1")
    halves = zones.withColumn("north", F.explode(F.filter(F.array(F.when(F.col("y1") > 0, F.lit(True)), F.when(F.col("y0") < 0, F.lit(False))), lambda v: v.isNotNull()))).select("n", "north").distinct()
    edge = lambda k: (F.col("n") + k) * ZONE - 180
    strips = halves.withColumns({"x0": edge(0), "x1": edge(1), "y0": F.when(F.col("north"), 0.0).otherwise(SOUTH), "y1": F.when(F.col("north"), NORTH).otherwise(0.0)})
    strips = strips.withColumns({"rings": rectangle_rings(*(F.col(c) for c in BOX)), "id": F.when(F.col("north"), 32601 + F.col("n")).otherwise(32701 + F.col("n"))})
    pieces = areas.intersections(shaped, strips, ZONE).select(F.col("right_id").alias("epsg"), "rings")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for epsg, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                moved = planar.reproject([dense([(p["x"], p["y"]) for p in r], step) for r in g], 4326, epsg)
                made.append([[{"x": x, "y": y} for x, y in r] for r in moved])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, b.schema.field(1).type)], ["epsg", "rings"])

    return areas.boxed(pieces.mapInArrow(run, pieces.schema))


def zone_tiles(area: DataFrame, size: float) -> DataFrame:
    """name, epsg, and the columns of ``tiles``: a grid over an area in degrees, in each UTM zone it meets."""
    cut = rings.cut(by_zone(area))
    zones = sorted(r["epsg"] for r in cut.select("epsg").distinct().collect())  # 120 at most
    made = [tiles(cut.where(F.col("epsg") == z), size).withColumn("epsg", F.lit(z)) for z in zones]
    if not made:
        made = [tiles(cut, size).withColumn("epsg", F.lit(0))]
    return reduce(DataFrame.unionByName, made).withColumn("name", F.concat_ws("_", "epsg", "tile_row", "tile_col"))
