"""Simplification that keeps neighbours together: borders are simplified as arcs that all polygons beside them share.

Boundaries are cut where polygons meet: at corners with other than two borders. Between those, borders are arcs; each is
simplified once, on its own, and every polygon is put together again from its arcs. So what two polygons share stays
shared, without gaps and overlaps, and no more than an arc or a polygon ever comes together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import overlay, planar
from . import rings
from .spatial import BOX, box_join

XY = rings.XY


def noded(layer: DataFrame, cell: float, digits: int = rings.DIGITS) -> DataFrame:
    """component (the id), ax, ay, bx, by: edges of all polygons between grid points, cut where another one's corner lies
    on them. layer has id, box and rings."""
    kind = dict(layer.dtypes)["id"]
    schema = f"component {kind}, edge int, t double, x double, y double"
    names = ["component", "edge", "t", "x", "y"]

    def number(shape: np.ndarray) -> np.ndarray:
        start = np.concatenate(([True], shape[1:] != shape[:-1])) if len(shape) else np.zeros(0, bool)
        return np.arange(len(shape)) - np.maximum.accumulate(np.where(start, np.arange(len(shape)), 0))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shape, e = overlay.edges_of(b.column(1))
            for t, k in ((0.0, 0), (1.0, 2)):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(shape)), pa.array(number(shape).astype(np.int32)), pa.array(np.full(len(e), t)), pa.array(e[:, k]), pa.array(e[:, k + 1])], names)

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine, other = (overlay.edges_of(b.column(k).field("rings")) for k in (0, 1))
            pair, edge, t, point = overlay.corners_on(overlay.Pairs(mine, other, b.num_rows))
            yield pa.RecordBatch.from_arrays([b.column(0).field("id").take(pa.array(pair)), pa.array(number(mine[0])[edge].astype(np.int32)), pa.array(t), pa.array(point[:, 0]), pa.array(point[:, 1])], names)

    pairs = box_join(layer, layer, cell).where("l.id <> r.id")
    points = layer.select("id", "rings").mapInArrow(own, schema).unionByName(pairs.mapInArrow(cuts, schema))
    along = Window.partitionBy("component", "edge").orderBy("t", "x", "y")
    steps = points.withColumns({"bx": F.lead("x").over(along), "by": F.lead("y").over(along)}).where("bx is not null")
    return rings.snapped(steps.select("component", F.col("x").alias("ax"), F.col("y").alias("ay"), "bx", "by"), digits)


def arcs(edges: DataFrame, block: int = rings.BLOCK) -> DataFrame:
    """closed, points (struct x, y, between grid points): the borders between corners with other than two borders, each once;
    a border without such a corner is closed and begins and ends at its least point."""
    ways = edges.select(*XY).unionByName(edges.select(F.col("bx").alias("ax"), F.col("by").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by"))).distinct()
    ways = rings.cut(ways)
    through = ways.groupBy("ax", "ay").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("bx", "by")).alias("p"), F.max(F.struct("bx", "by")).alias("q")).where("n = 2")
    through = through.select(F.col("ax").alias("vx"), F.col("ay").alias("vy"), "p", "q")
    met = ways.join(through, (F.col("bx") == F.col("vx")) & (F.col("by") == F.col("vy")), "left")
    onward = F.when((F.col("p.bx") == F.col("ax")) & (F.col("p.by") == F.col("ay")), F.col("q")).otherwise(F.col("p"))
    nodes = met.withColumn("n", onward).select(F.lit(0).alias("component"), *XY, F.col("n.bx").alias("nx"), F.col("n.by").alias("ny"))
    listed = rings.ranked(nodes, block).groupBy("ring", "closed").agg(F.array_sort(F.collect_list(F.struct("nth", "edges"))).alias("all"))
    e = F.flatten(F.transform("all", lambda p: p["edges"]))
    point = lambda v, k: F.struct(v[f"{k}x"].alias("x"), v[f"{k}y"].alias("y"))
    listed = listed.select("closed", F.transform(e, lambda v: point(v, "a")).alias("begins"), F.transform(e, lambda v: point(v, "b")).alias("ends"))
    at = F.array_position("begins", F.array_min("begins")).cast("int")
    turned = lambda at: F.concat(F.slice("begins", at, F.size("begins")), F.slice("begins", F.lit(1), at))
    points = F.when(F.col("closed"), turned(at)).otherwise(F.concat(F.slice("begins", 1, 1), F.col("ends")))
    # of the two ways along a border, the one that is less from its beginning
    return listed.select("closed", points.alias("points")).where(F.col("points") <= F.reverse("points"))


def line(points: Column) -> Column:
    """Edges (struct ax, ay, bx, by) along points."""
    onward = F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0)))
    return F.transform(F.arrays_zip(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))).alias("p"), onward.alias("q")), lambda v: F.struct(v["p"]["x"].alias("ax"), v["p"]["y"].alias("ay"), v["q"]["x"].alias("bx"), v["q"]["y"].alias("by")))


def fewer(found: DataFrame, tolerance: float) -> DataFrame:
    """Arcs (and whatever else found has) with less: the points left by Douglas and Peucker's method, and spare: the same
    with the farthest point where only the ends are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            less, spare = [], []
            for points, closed in zip(b["points"], b["closed"].to_pylist(), strict=True):
                x, y = (np.asarray(points.values.field(k)) for k in (0, 1))
                for out, least in ((less, False), (spare, True)):
                    kept = planar.kept_points(x, y, tolerance, closed, least)
                    out.append([{"x": p, "y": q} for p, q in zip(x[kept].tolist(), y[kept].tolist(), strict=True)])
            kind = b.schema.field("points").type
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(less, kind), pa.array(spare, kind)], [*b.schema.names, "less", "spare"])

    kind = found.schema["points"].dataType
    return found.mapInArrow(run, StructType([*found.schema.fields, StructField("less", kind), StructField("spare", kind)]))


def simplified(layer: DataFrame, cell: float, tolerance: float, max_count: int | None = None, digits: int = rings.DIGITS, key: str = "id") -> DataFrame:
    """id, part, area, rings of each polygon of a layer (key, box, rings), its borders simplified.

    With max_count, borders of a polygon with so many corners or fewer stay as they are. Two borders between the same
    corners do not both become the straight line, and closed ones keep three points. Null and empty rings have no row.
    Corners that lie on a neighbour's edge count as its corners as well.
    """
    layer = layer.where("size(rings) > 0").select(F.col(key).alias("id"), *BOX, "rings")
    edges = rings.cut(noded(layer, cell, digits))
    found = rings.cut(arcs(edges).withColumn("arc", F.xxhash64("points")))
    made = fewer(found, tolerance * 10**digits)
    ends = Window.partitionBy("e")
    straight = F.size("less") == 2
    tied = made.withColumn("e", F.array_sort(F.array(F.element_at("points", 1), F.element_at("points", -1)))).withColumn("n", F.sum(straight.cast("int")).over(ends))
    made = rings.cut(tied.select("arc", "points", F.when(straight & (F.col("n") > 1), F.col("spare")).otherwise(F.col("less")).alias("less")))
    whole = made.select("arc", F.explode(line(F.col("points"))).alias("e"))
    back = F.struct(F.col("e.bx").alias("ax"), F.col("e.by").alias("ay"), F.col("e.ax").alias("bx"), F.col("e.ay").alias("by"))
    sides = whole.select("arc", F.lit(True).alias("there"), "e.*").unionByName(whole.select("arc", F.lit(False).alias("there"), back.alias("e")).select("arc", "there", "e.*"))
    used = rings.cut(edges.join(sides, list(XY)).select("component", "arc", "there").distinct())
    if max_count is not None:
        corners = F.aggregate(F.transform("rings", F.size), F.lit(0), lambda s, n: s + n)
        few = layer.where(corners <= max_count).select(F.col("id").alias("component"))
        kept = used.join(few, "component", "left_semi").select("arc", F.lit(True).alias("kept")).distinct()
        made = made.join(kept, "arc", "left").withColumn("less", F.when(F.col("kept"), F.col("points")).otherwise(F.col("less")))
    way = F.when(F.col("there"), F.col("less")).otherwise(F.reverse("less"))
    again = used.join(made.select("arc", "less"), "arc").select("component", F.explode(line(way)).alias("e")).select("component", *[(F.col(f"e.{c}") / float(10**digits)).alias(c) for c in XY])
    return rings.polygons(again, digits).withColumnRenamed("component", "id")
