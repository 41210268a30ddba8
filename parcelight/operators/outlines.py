"""Large areas as edges (ax, ay, bx, by) that bound them, in any order: which polygons share a point with one.

A polygon shares a point with an area if it does with one of its edges, or lies in the area as a whole. Both are decided in
cells, so no row holds the area and no polygon meets edges that are far from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import overlay
from . import crowds, rings
from .spatial import BOX

ENDS = rings.XY
#: Edges of an area in a cell, if they were spread evenly over its box.
IN_CELL = 32


def of(area: DataFrame) -> DataFrame:
    """The edges of polygons (rings)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = overlay.edges_of(b.column(0))[1]
            for k in range(0, len(e), crowds.ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in e[k : k + crowds.ROWS].T], ENDS)

    return area.where("size(rings) > 0").select("rings").mapInArrow(run, ", ".join(f"{c} double" for c in ENDS))


def _touch(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Whether edges e and f share a point."""
    (p, q), (r, s) = overlay.side(e, f), overlay.side(f, e)
    out = (np.sign(p) * np.sign(q) <= 0) & (np.sign(r) * np.sign(s) <= 0)
    for c in (0, 1):
        out &= np.minimum(e[:, c], e[:, c + 2]) <= np.maximum(f[:, c], f[:, c + 2])
        out &= np.minimum(f[:, c], f[:, c + 2]) <= np.maximum(e[:, c], e[:, c + 2])
    return out


def touched(layer: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """id of the rows of a layer (id, box, rings) that share a point with an edge."""
    low, high = (lambda p, q: F.least(p, q)), (lambda p, q: F.greatest(p, q))
    other = edges.select(*ENDS, low("ax", "bx").alias("x0"), low("ay", "by").alias("y0"), high("ax", "bx").alias("x1"), high("ay", "by").alias("y1"))
    mine = layer.select("id", *crowds.boxes(), "rings", F.lit(True).alias("mine"))
    a, b = crowds.levels(mine, cell), crowds.levels(other, cell)
    if not a or not b:
        return layer.where("false").select("id")
    placed = crowds.cells(mine, cell, b).unionByName(crowds.cells(other, cell, a), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in crowds.groups(batches, crowds.GROUP):
            box, own, size = crowds.boxed(t)
            asks = np.asarray(t["mine"].fill_null(False))
            shapes, lines = crowds.Edges(t["rings"]), np.stack([t[c].fill_null(0).to_numpy() for c in ENDS], axis=1)
            open_, hit = np.flatnonzero(asks), np.zeros(t.num_rows, bool)
            for chosen in crowds.rounds(group, np.flatnonzero(~asks), size):
                for i, j in crowds.cross(group[open_], group[chosen]):
                    i, j = open_[i], chosen[j]
                    ok = (own[i] | own[j]) & crowds.meet(box[i], box[j]) & ~hit[i]
                    i, j = i[ok], j[ok]
                    for k in range(0, len(i), crowds.SHAPES):
                        x, y = i[k : k + crowds.SHAPES], j[k : k + crowds.SHAPES]
                        pair, e = shapes.of(x)
                        f = lines[y][pair]
                        inside = np.bincount(pair[overlay.within(f[:, 0], f[:, 1], e)], minlength=len(x)) % 2 == 1
                        inside[pair[_touch(e, f)]] = True
                        hit[x[inside]] = True
                open_ = open_[~hit[open_]]
                if not len(open_):
                    break
            yield pa.RecordBatch.from_arrays([t["id"].take(pa.array(np.flatnonzero(hit)))], ["id"])

    rows = placed.select("id", *BOX, "rings", "mine", *ENDS, "level", *crowds.GROUP)
    return rows.repartition(*crowds.GROUP).sortWithinPartitions(*crowds.GROUP).mapInArrow(run, f"id {dict(layer.dtypes)['id']}").distinct()


def above(e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether points lie above the lines of edges that run to the right. One that lies on a line is taken to be a little
    higher and further right, as it is where heights and ends are compared."""
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    s = dx * (y - e[:, 1]) - dy * (x - e[:, 0])
    return (s > 0) | ((s == 0) & (dy <= 0))


def crossed(e: np.ndarray, x: np.ndarray, y: np.ndarray, level: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Whether the way from a point up or down to a level, and on to the right among the edges that cross the level here,
    crosses an edge an odd number of times."""
    e = np.where((e[:, 0] > e[:, 2])[:, None], e[:, [2, 3, 0, 1]], e)
    corner = above(e, x, level)
    first = ((e[:, 0] > x) != (e[:, 2] > x)) & (above(e, x, y) != corner)
    before = np.where(e[:, 0] == e[:, 2], x < e[:, 0], corner == (e[:, 3] > e[:, 1]))  # whether the corner is left of the edge
    return first ^ (here & before)


def placed(edges: DataFrame, wide: float) -> DataFrame:
    """edges for each cell (r, i) of that size they run through, and here: whether an edge crosses the cell's middle height
    in it. Where rounding leaves that open, an edge comes in a cell more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = np.stack([b[c].to_numpy() for c in ENDS], axis=1)
            low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
            first = np.floor(low / wide).astype(np.int64)
            n = np.floor(high / wide).astype(np.int64) - first + 1
            k, r = np.repeat(np.arange(len(e)), n), overlay.ranges(first, n)
            x, y, dx, dy = e[k, 0], e[k, 1], e[k, 2] - e[k, 0], e[k, 3] - e[k, 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                at = lambda height: np.where(dy == 0, x, x + (height - y) / dy * dx)
                p, q, middle = at(np.maximum(low[k], r * wide)), at(np.minimum(high[k], (r + 1) * wide)), at((r + 0.5) * wide)
            p, q = np.where(dy == 0, x, p), np.where(dy == 0, x + dx, q)
            left, right = np.minimum(e[k, 0], e[k, 2]), np.maximum(e[k, 0], e[k, 2])
            p, q, middle = (np.clip(v, left, right) for v in (p, q, middle))
            spare = 1e-9 * (wide + np.abs(x) + np.abs(dx))
            level = (r + 0.5) * wide
            crosses, home = (e[k, 1] > level) != (e[k, 3] > level), np.floor(middle / wide).astype(np.int64)
            start = np.minimum(np.floor((np.minimum(p, q) - spare) / wide).astype(np.int64), np.where(crosses, home, np.iinfo(np.int64).max))
            stop = np.maximum(np.floor((np.maximum(p, q) + spare) / wide).astype(np.int64), np.where(crosses, home, np.iinfo(np.int64).min))
            m = stop - start + 1
            c, i = np.repeat(np.arange(len(k)), m), overlay.ranges(start, m)
            for s in range(0, len(c), crowds.PAIRS):
                some = slice(s, s + crowds.PAIRS)
                own = c[some]
                yield pa.RecordBatch.from_arrays([*map(pa.array, e[k[own]].T), pa.array(r[own]), pa.array(i[some]), pa.array(crosses[own] & (home[own] == i[some]))], [*ENDS, "r", "i", "here"])

    return edges.select(*ENDS).mapInArrow(run, ", ".join(f"{c} double" for c in ENDS) + ", r long, i long, here boolean")


def holding(points: DataFrame, edges: DataFrame) -> DataFrame:
    """id of the points (id, x, y) that lie in the area, off its edges: from a point to the middle height of its cell, and
    on to the right, an odd number of edges are crossed. Beyond the cell they are counted for whole cells."""
    long = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    side = lambda p, q: F.max(F.greatest(p, q)) - F.min(F.least(p, q))
    all_ = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(long).alias("long"), side("ax", "bx").alias("w"), side("ay", "by").alias("h")).first()
    if not all_["n"]:
        return points.where("false").select("id")
    wide = max(np.sqrt(all_["w"] * all_["h"] * IN_CELL / all_["n"]), all_["long"] / all_["n"])
    lines = rings.cut(placed(edges, wide))
    where = points.withColumns({"r": F.floor(F.col("y") / wide), "i": F.floor(F.col("x") / wide)})
    asked = where.select("r", "i").distinct().withColumn("n", F.lit(0).cast("long")).withColumn("asked", F.lit(True))
    held = lines.where("here").groupBy("r", "i").agg(F.count(F.lit(1)).alias("n")).withColumn("asked", F.lit(False))
    beyond = Window.partitionBy("r").orderBy(F.desc("i")).rangeBetween(Window.unboundedPreceding, -1)
    far = asked.unionByName(held).withColumn("far", F.coalesce(F.sum("n").over(beyond), F.lit(0)) % 2 == 1).where("asked").select("r", "i", "far")
    rows = where.join(far, ["r", "i"]).unionByName(lines, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in crowds.groups(batches, ("r", "i")):
            asks = np.asarray(t["here"].is_null())
            p, q = np.flatnonzero(asks), np.flatnonzero(~asks)
            x, y = (t[c].fill_null(0).to_numpy() for c in ("x", "y"))
            e, here = np.stack([t[c].fill_null(0).to_numpy() for c in ENDS], axis=1), np.asarray(t["here"].fill_null(False))
            level = (t["r"].to_numpy() + 0.5) * wide
            odd = np.asarray(t["far"].fill_null(False)).astype(np.int64)
            for i, j in crowds.cross(group[p], group[q]):
                i, j = p[i], q[j]
                odd += np.bincount(i[crossed(e[j], x[i], y[i], level[i], here[j])], minlength=len(odd))
            yield pa.RecordBatch.from_arrays([t["id"].take(pa.array(np.flatnonzero(asks & (odd % 2 == 1))))], ["id"])

    wanted = rows.select("id", "x", "y", "far", *ENDS, "here", "r", "i").repartition("r", "i").sortWithinPartitions("r", "i")
    return wanted.mapInArrow(run, f"id {dict(points.dtypes)['id']}")


def sharing(layer: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """id of the rows of a layer (id, box, rings) that share a point with an area."""
    hit = rings.cut(touched(layer, edges, cell))
    first = F.element_at(F.element_at("rings", 1), 1)
    points = layer.join(hit, "id", "left_anti").select("id", first["x"].alias("x"), first["y"].alias("y"))
    return hit.unionByName(holding(points, edges).distinct())
