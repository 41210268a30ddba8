"""Dissolving overlapping shapes: components of their overlap graph, and one merged shape for each.

In place of a sequential stitch over chunks, rows and layers, all overlaps are edges of one graph, and its components are
found at once. The result does not depend on the order of layers or the size of chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import overlay
from . import crowds
from .components import components
from .rings import polygons
from .spatial import BOX


def overlap_edges(layer: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """a < b for rows of one layer whose boxes share a point: not all pairs, but enough to reach the same ones."""
    return crowds.forest(layer, cell, key)


def connected(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """nodes with component: the smallest key reachable over edges (a, b)."""
    roots = components(edges).withColumnRenamed("node", "n")
    return nodes.join(roots, nodes[key] == roots["n"], "left").withColumn("component", F.coalesce("root", F.col(key))).drop("n", "root")


def dissolve_boxes(layer: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """component, its number of shapes and its bounds."""
    named = connected(layer, overlap_edges(layer, cell, key), key)
    return named.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def merge_zones(layer: DataFrame, zone: str, cell: float, max_area: float | None = None, key: str = "id") -> DataFrame:
    """Two zones as one layer: shapes that meet one of the other zone are dissolved, the others pass as they are, and
    merged shapes of max_area or more go."""
    named = connected(layer, crowds.forest(layer.where(F.col(zone).isin(0, 1)), cell, key, zone), key)
    merged = named.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    out = merged.withColumn("box_area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    return out if max_area is None else out.where(F.col("box_area") < max_area)


def outline(layer: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """component, ax, ay, bx, by: what bounds the union of each component's polygons, as edges with the inside on their
    left. layer has key, component, box and rings (null and empty rings bound nothing).

    Each polygon's edges are cut where another one of its component covers them. Cells are looked at on their own, and in a
    cell what is once covered is not compared again. No component is gathered anywhere.
    """
    return crowds.uncovered(layer.select(F.col(key).alias("id"), "component", *BOX, "rings"), cell, (overlay.INSIDE, overlay.OPPOSITE))


def measures(edges: DataFrame) -> DataFrame:
    """component, area, perimeter and bounds of what an outline bounds."""
    strip = (F.col("ax") - F.col("bx")) * (F.col("ay") + F.col("by")) / 2
    return edges.groupBy("component").agg(
        F.sum(strip).alias("area"), F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("perimeter"), F.min("ax").alias("x0"), F.min("ay").alias("y0"), F.max("ax").alias("x1"), F.max("ay").alias("y1")
    )


def met(left: DataFrame, right: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """Edges a < b that link what pairs of rows of two layers, of other keys, do whose polygons share a point."""
    both = left.select(key, *BOX, "rings", F.lit(0).alias("zone")).unionByName(right.select(key, *BOX, "rings", F.lit(1).alias("zone")))
    return crowds.forest(both, cell, key, "zone", shaped=True)


def dissolve(layer: DataFrame, cell: float, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(key and component of each polygon, the outline of each component): polygons that share a point are one shape."""
    layer = layer.select(key, *BOX, "rings")
    named = connected(layer, crowds.forest(layer, cell, key, shaped=True), key)
    return named.select(key, "component"), outline(named, cell, key)


def merge_zone_shapes(layer: DataFrame, zone: str, cell: float, max_area: float | None = None, key: str = "id") -> DataFrame:
    """Two zones' polygons as one layer, in one reference system: component, part, area, rings of single polygons.

    Polygons that share a point with one of the other zone are dissolved, the others pass as they are. Parts that touch in
    points only are polygons of their own, and those whose own area is max_area or more go.
    """
    a, b = (layer.where(F.col(zone) == z).select(key, *BOX, "rings") for z in (0, 1))
    named = connected(layer.select(key, *BOX, "rings"), met(a, b, cell, key), key)
    made = polygons(outline(named, cell, key))
    return made if max_area is None else made.where(F.col("area") < max_area)
