"""Two zones' polygons as one layer: what overlaps is merged, the rest passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arcs, areas, dissolve, outlines, rings, spatial
from .spatial import BOX


def overlap(left: DataFrame, right: DataFrame, cell: float, shrink: float = 1e-4, key: str = "id") -> DataFrame:
    """Box and rings of what the unions of two zones' tiles (key, box, rings, in one reference system) share, narrowed a
    little, so that tiles which only touch it are not counted in."""
    both = areas.shared(left, right, cell, key).select("rings").withColumn("id", F.xxhash64("rings"))
    return areas.boxed(rings.cut(areas.buffered(both, -shrink).select("rings")))


def overlap_edges(left: DataFrame, right: DataFrame, cell: float, shrink: float = 1e-4, key: str = "id") -> DataFrame:
    """ax, ay, bx, by: the edges of ``overlap``, which is one polygon of very many corners where tiles lie dense; no row
    holds it. Where edges do not close, point by point, they are traced first as ``overlap`` does."""
    both = rings.cut(areas.shared(left, right, cell, key).select("rings").withColumn("id", F.xxhash64("rings")))
    made = rings.cut(rings.mended(rings.cut(rings.snapped(areas.buffer_edges(both, -shrink)))))
    end = lambda k, n: made.select("component", F.col(f"{k}x").alias("x"), F.col(f"{k}y").alias("y"), F.lit(n).alias("n"))
    if end("a", 1).unionByName(end("b", -1)).groupBy("component", "x", "y").agg(F.sum("n").alias("n")).where("n <> 0").isEmpty():
        return made.select(*[(F.col(c) / float(10**rings.DIGITS)).alias(c) for c in rings.XY])
    return rings.cut(outlines.of(areas.buffered(both, -shrink)))


def split(tiles: DataFrame, shared: DataFrame, zone: str, cell: float, widen: float = 1e-5, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(the tiles that share a point with the zones' overlap; zone, rings: the union of each zone's other tiles, widened a
    little)."""
    apart, hit = areas.split_by_area(tiles, shared, cell, key)
    unions = rings.polygons(dissolve.outline(apart.withColumn("component", F.col(zone)), cell, key))
    named = unions.select(F.struct("component", "part").alias("id"), "rings")
    return hit, areas.buffered(named, widen).select(F.col("id.component").alias(zone), "rings")


def merged(
    left: DataFrame,
    right: DataFrame,
    epsg: tuple[int, int],
    resulting: int,
    cell: float,
    overlap: DataFrame | None = None,
    max_area: float | None = None,
    tolerance: float | None = 2.5,
    together: bool = False,
    key: str = "id",
) -> DataFrame:
    """source, area, rings of single polygons in the resulting reference system, from two layers (key: long, rings), each in
    its own (epsg).

    Polygons of max_area or more go first. Then both layers are brought into the resulting system. Those apart from the
    zones' overlap (box and rings in that system; none: everything overlaps) pass as they are (source apart), and so do
    those that share no point with one of the other zone (alone). The others are dissolved, and the union falls into
    single polygons (merged). At last those of max_area or more go again, and rings are simplified: each polygon on its
    own, or with its neighbours (together). A tolerance of None changes nothing.
    """
    layers = []
    for zone, (layer, code) in enumerate(zip((left, right), epsg, strict=True)):
        some = spatial.under_area(layer.select((F.col(key) * 2 + zone).alias("id"), "rings"), "rings", max_area).drop("area")
        layers.append(areas.boxed(rings.cut(spatial.reprojected(some, "rings", code, resulting))))
    apart, hit = zip(*[(x.where("false"), x) if overlap is None else areas.split_by_area(x, overlap, cell) for x in layers], strict=True)
    hit = [rings.cut(x.select("id", *BOX, "rings")) for x in hit]
    edges = rings.cut(dissolve.met(*hit, cell))
    both = hit[0].unionByName(hit[1])
    paired = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    named = dissolve.connected(both.join(paired, "id", "left_semi"), edges)
    union = rings.polygons(dissolve.outline(named, cell)).select(F.lit("merged").alias("source"), "rings")
    passed = both.join(paired, "id", "left_anti").select(F.lit("alone").alias("source"), "rings")
    for x in apart:
        passed = passed.unionByName(x.select(F.lit("apart").alias("source"), "rings"))
    out = rings.cut(spatial.under_area(union.unionByName(passed), "rings", max_area).select("source", "area", "rings"))
    if tolerance is None:
        return out
    if not together:
        changed = spatial.simplified(out, "rings", tolerance)
        return changed.withColumn("area", spatial.area(F.col("rings")))
    ready = areas.boxed(out.withColumn("id", F.struct(F.xxhash64("rings").alias("h"), F.element_at(F.element_at("rings", 1), 1).alias("p"))))
    made = arcs.simplified(ready, cell, tolerance)
    return made.join(ready.select("id", "source"), "id").select("source", "area", "rings")
