"""Rings and lines out of directed edges, without gathering what they bound.

An edge knows the one that follows it from the edges around their common point. Edges are chained inside bounded blocks
of neighbours, and what is left of a ring that runs through several blocks gets its order by list ranking: in each round
a piece learns from the one that follows, twice as far ahead as before. How edges fall into blocks changes the number of
pieces and nothing else, so blocks are cut by count along a space-filling curve, and no place, shape or component has to
fit into one.

Edges have a component (any type), ax, ay, bx, by, and the inside on their left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import checkpoint_folder, dropped, stored
from .spatial import box_join

#: Digits after the point to which ends are rounded before they meet; edges of a block.
DIGITS, BLOCK = 6, 1 << 16
XY = ("ax", "ay", "bx", "by")
NODE = (*XY, "nx", "ny")


def cut(df: DataFrame) -> DataFrame:
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def snapped(edges: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Edges between points of a grid, as whole numbers. Equal ones are one; two that run against each other are none."""
    grid = lambda c: F.round(F.col(c) * float(10**digits)).cast("long").alias(c)
    return whole(edges.select("component", *[grid(c) for c in XY]))


def mended(edges: DataFrame) -> DataFrame:
    """Edges (between grid points) whose ends meet: a point that is worked out twice may be rounded to two neighbours. Where
    more edges come than go or the other way round, a point is moved to the least such one among its neighbours."""
    end = lambda k, n: edges.select("component", F.col(f"{k}x").alias("x"), F.col(f"{k}y").alias("y"), F.lit(n).alias("n"))
    odd = cut(end("a", 1).unionByName(end("b", -1)).groupBy("component", "x", "y").agg(F.sum("n").alias("n")).where("n <> 0").drop("n"))
    if odd.isEmpty():
        return edges
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    point = F.struct("x", "y")
    seen = odd.select("component", point.alias("p"), F.explode(steps).alias("s")).select("component", "p", (F.col("p.x") + F.col("s.i")).alias("x"), (F.col("p.y") + F.col("s.j")).alias("y"))
    least = seen.groupBy("component", "x", "y").agg(F.min("p").alias("p"))
    moved = cut(least.join(odd.withColumnRenamed("component", "c2"), F.col("component").eqNullSafe(F.col("c2")) & (least["x"] == odd["x"]) & (least["y"] == odd["y"])).select("component", least["x"], least["y"], "p").where(F.col("p") != point))
    out = edges
    for k in "ab":
        to = moved.select(F.col("component").alias("c2"), F.col("x").alias("x2"), F.col("y").alias("y2"), "p")
        out = out.join(to, F.col("component").eqNullSafe(F.col("c2")) & (F.col(f"{k}x") == F.col("x2")) & (F.col(f"{k}y") == F.col("y2")), "left")
        out = out.withColumns({f"{k}x": F.coalesce("p.x", F.col(f"{k}x")), f"{k}y": F.coalesce("p.y", F.col(f"{k}y"))}).drop("c2", "x2", "y2", "p")
    return whole(out)


def whole(edges: DataFrame) -> DataFrame:
    """Edges between grid points: equal ones are one, and two that run against each other are none."""
    a, b = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    ways = edges.where(a != b).groupBy("component", F.least(a, b).alias("p"), F.greatest(a, b).alias("q")).agg(F.bool_or(a < b).alias("there"), F.bool_or(a > b).alias("back"))
    one = ways.where(F.col("there") != F.col("back"))
    end = lambda k, c: F.when(F.col("there"), F.col(f"{k}.{c}")).otherwise(F.col(f"{'q' if k == 'p' else 'p'}.{c}"))
    return one.select("component", end("p", "x").alias("ax"), end("p", "y").alias("ay"), end("q", "x").alias("bx"), end("q", "y").alias("by"))


def linked(edges: DataFrame) -> DataFrame:
    """Edges (between grid points) with nx, ny, the end of the edge that follows: the sharpest turn to the left."""
    angle = lambda p, q: F.atan2((F.col(f"{q}y") - F.col(f"{p}y")).cast("double"), (F.col(f"{q}x") - F.col(f"{p}x")).cast("double"))
    point = lambda p: F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y"))
    none = F.lit(None).cast("struct<x:bigint,y:bigint>")
    row = lambda at, far, comes, goes, kind: edges.select("component", F.col(f"{at}x").alias("vx"), F.col(f"{at}y").alias("vy"), angle(at, far).alias("angle"), comes.alias("comes"), goes.alias("goes"), F.lit(kind).alias("kind"))
    ends = row("b", "a", point("a"), none, 0).unionByName(row("a", "b", none, point("b"), 1))
    around = "partition by component, vx, vy order by angle desc, kind"
    following = F.coalesce(F.expr(f"lead(goes) ignore nulls over ({around})"), F.expr(f"first(goes) ignore nulls over ({around} rows between unbounded preceding and unbounded following)"))
    found = ends.withColumn("n", following).where("comes is not null")
    return found.select("component", F.col("comes.x").alias("ax"), F.col("comes.y").alias("ay"), F.col("vx").alias("bx"), F.col("vy").alias("by"), F.col("n.x").alias("nx"), F.col("n.y").alias("ny"))


def curve(x: Column, y: Column) -> Column:
    """The place of a grid point on a Z curve, coarsened by 2^14 grid units."""

    def spread(v: Column) -> Column:
        v = F.shiftright(v + F.lit(1 << 44), 14).bitwiseAND(F.lit((1 << 31) - 1))
        for by, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, by)).bitwiseAND(F.lit(mask))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def _walk(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of its chain, steps from there) of each place, from the place before (its own if it is the first)."""
    at, steps = before.copy(), (before != np.arange(len(before))).astype(np.int64)
    for _ in range(max(1, int(len(before)).bit_length())):
        steps += steps[at]
        at = at[at]
    return at, steps


def _chains(own: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first of its chain, steps from there, whether the chain is a whole ring) of each edge of a block.

    own and following name edges by rows of numbers; an edge that is followed by none of the block ends its chain.
    """
    n = len(own)
    rows = np.ascontiguousarray(np.concatenate((own, following)))
    _, name = np.unique(rows.view([("", rows.dtype)] * rows.shape[1]).ravel(), return_inverse=True)
    owner = np.full(2 * n, -1)
    owner[name[:n]] = np.arange(n)
    onward = owner[name[n:]]
    before = np.arange(n)
    before[onward[onward >= 0]] = np.flatnonzero(onward >= 0)
    first = before == np.arange(n)
    at, _ = _walk(before)
    ring = ~first[at]
    if ring.any():  # cut each ring before its least place
        least, jump = np.arange(n), before.copy()
        for _ in range(int(n).bit_length()):
            least = np.minimum(least, least[jump])
            jump = jump[jump]
        start = ring & (least == np.arange(n))
        before[start] = np.flatnonzero(start)
    return *_walk(before), ring


def pieces(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """component, first (ax, ay, bx, by), following (the edge after the last; null if there is none), closed, edges (in
    order): chains of the edges with successors, as far as they stay in one block."""
    nodes = cut(nodes.withColumns({"z": curve(F.col("ax"), F.col("ay")), "code": F.xxhash64("component")}))
    kind = nodes.schema["component"].dataType.simpleString()
    node = pa.struct([(c, pa.int64()) for c in NODE])
    edge = pa.struct([(c, pa.int64()) for c in XY])

    def chained(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.concat_batches(batches)
        part = t["code"].to_numpy()
        v = {c: t[c].to_numpy(zero_copy_only=False) for c in XY}
        ends = np.asarray(t["nx"].is_null())
        v |= {c: t[c].fill_null(0).to_numpy(zero_copy_only=False) for c in ("nx", "ny")}
        own = np.stack([part, *(v[c] for c in XY)], axis=1)
        following = np.stack([part, v["bx"], v["by"], v["nx"], v["ny"]], axis=1)
        following[ends, 1:] = np.iinfo(np.int64).min  # no edge
        head, steps, ring = _chains(own, following)
        order = np.lexsort((steps, head))
        begin = np.flatnonzero(np.concatenate(([True], head[order][1:] != head[order][:-1])))
        firsts, lasts = order[begin], order[np.concatenate((begin[1:], [len(order)])) - 1]
        taken = [t[c].take(pa.array(order)) for c in NODE]
        edges = pa.ListArray.from_arrays(pa.array(np.concatenate((begin, [len(order)])).astype(np.int32)), pa.StructArray.from_arrays(taken, fields=list(node)))
        first = pa.StructArray.from_arrays([pa.array(v[c][firsts]) for c in XY], fields=list(edge))
        onward = pa.StructArray.from_arrays([pa.array(v[c][lasts]) for c in ("bx", "by", "nx", "ny")], fields=list(edge), mask=pa.array(ends[lasts]))
        return pa.RecordBatch.from_arrays([t["component"].take(pa.array(firsts)), first, onward, pa.array(ring[firsts]), edges], ["component", "first", "following", "closed", "edges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while n + batch.num_rows >= block:
                yield chained([*held, batch.slice(0, block - n)])
                held, n, batch = [], 0, batch.slice(block - n)
            if batch.num_rows:
                held, n = [*held, batch], n + batch.num_rows
        if n:
            yield chained(held)

    dealt = nodes.repartitionByRange("component", "z", "ax", "ay").sortWithinPartitions("component", "z", *XY).drop("z")
    four = "struct<ax:bigint,ay:bigint,bx:bigint,by:bigint>"
    return dealt.select("component", "code", *NODE).mapInArrow(run, f"component {kind}, first {four}, following {four}, closed boolean, edges array<struct<{','.join(f'{c}:bigint' for c in NODE)}>>")


def ranked(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """component, ring (a name), closed, nth, edges: all pieces of a ring or line in order of nth. Lines begin at an edge
    that follows none and end at one that none follows; rings begin anywhere."""
    chains, _ = stored(pieces(nodes, block))
    line = F.col("following").isNull()
    name = F.struct((~line).cast("int").alias("kind"), F.col("first.*"))
    whole = chains.where("closed").select("component", name.alias("ring"), "closed", F.lit(0).cast("long").alias("nth"), "edges")
    open_ = chains.where("not closed")
    state, path = stored(open_.select("component", "first", F.col("following").alias("ahead"), name.alias("ring"), F.lit(0).cast("long").alias("far")))
    reach = 1
    while not state.where("ahead is not null").isEmpty():
        other = state.select(F.col("component").alias("c2"), F.col("first").alias("f2"), F.col("ahead").alias("a2"), F.col("ring").alias("r2"), F.col("far").alias("d2"))
        nearer = F.coalesce(F.col("r2") < F.col("ring"), F.lit(False))
        step = state.join(other, (F.col("component").eqNullSafe(F.col("c2"))) & (F.col("ahead") == F.col("f2")), "left")
        step = step.select("component", "first", F.col("a2").alias("ahead"), F.when(nearer, F.col("r2")).otherwise(F.col("ring")).alias("ring"), F.when(nearer, F.col("d2") + reach).otherwise(F.col("far")).alias("far"), nearer.alias("changed"))
        before, (state, path) = path, stored(step)
        dropped(nodes.sparkSession, before)
        reach *= 2
        if state.where("changed").isEmpty():  # every piece of a ring has seen the least name of it
            break
    named = state.select(F.col("component").alias("c2"), F.col("first").alias("f2"), "ring", "far")
    rest = open_.join(named, F.col("component").eqNullSafe(F.col("c2")) & (F.col("first") == F.col("f2")))
    return whole.unionByName(rest.select("component", "ring", (F.col("ring.kind") == 1).alias("closed"), (-F.col("far")).alias("nth"), "edges"))


def parted(rings: DataFrame, block: int = BLOCK) -> DataFrame:
    """Closed rings such that none passes a point twice: one that does is taken apart there."""
    rings = cut(rings)
    steps = rings.select("component", "ring", "nth", F.posexplode("edges").alias("at", "e"))
    twice = cut(steps.groupBy("component", "ring", "e.bx", "e.by").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component", "ring").distinct())
    if twice.isEmpty():
        return rings
    same = lambda df: df.withColumnsRenamed({"component": "c2", "ring": "r2"})
    on = F.col("component").eqNullSafe(F.col("c2")) & (F.col("ring") == F.col("r2"))
    passes = Window.partitionBy("component", "ring", "e.bx", "e.by").orderBy("nth", "at")
    last = passes.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.struct("e.nx", "e.ny")
    apart = steps.join(same(twice), on, "left_semi").withColumn("n", F.coalesce(F.lag(n).over(passes), F.last(n).over(last)))
    again = ranked(apart.select("component", *[f"e.{c}" for c in XY], "n.nx", "n.ny"), block)
    return rings.join(same(twice), on, "left_anti").unionByName(again)


def bend(e: Column) -> Column:
    """Whether an edge and the one that follows do not run straight on, by more than a grid unit."""
    d = lambda p, q: (e[q] - e[p]).cast("double")
    side = d("ax", "bx") * d("by", "ny") - d("ay", "by") * d("bx", "nx")
    return F.abs(side) > F.hypot(d("ax", "nx"), d("ay", "ny"))


def closed_rings(edges: DataFrame, digits: int = DIGITS, block: int = BLOCK) -> DataFrame:
    """component, ring, nth, edges of the rings that edges make, in pieces: their ends meet if they agree in so many digits."""
    return parted(ranked(linked(mended(cut(snapped(edges, digits)))), block).where("closed"), block)


def ring_measures(pieces_: DataFrame, digits: int = DIGITS) -> DataFrame:
    """component, ring, area (negative for a hole), n (bends), box and a point (px, py) on the boundary; no ring is gathered."""
    unit = float(10**digits)
    e = F.col("e")
    flat = pieces_.select("component", "ring", F.explode("edges").alias("e"))
    c = lambda k: e[k] / unit
    strip = (c("ax") - c("bx")) * (c("ay") + c("by")) / 2
    middle = F.min(F.struct(((c("ax") + c("bx")) / 2).alias("x"), ((c("ay") + c("by")) / 2).alias("y")))
    made = flat.groupBy("component", "ring").agg(F.sum(strip).alias("area"), F.sum(bend(e).cast("int")).alias("n"), F.min(c("bx")).alias("x0"), F.min(c("by")).alias("y0"), F.max(c("bx")).alias("x1"), F.max(c("by")).alias("y1"), middle.alias("p"))
    return made.where("n > 2 and area <> 0").select("component", "ring", "area", "n", "x0", "y0", "x1", "y1", F.col("p.x").alias("px"), F.col("p.y").alias("py"))


def owners(rings: DataFrame, pieces_: DataFrame, digits: int = DIGITS) -> DataFrame:
    """component, ring, owner for each hole (of measured rings): the least exterior of its component around it.

    Where a component has one exterior, that is it. Else a hole's point meets the exteriors whose boxes hold it, and is in
    one if a ray crosses it an odd number of times; a ray only meets the edges in its own band, and crossings are counted.
    """
    outer, holes = rings.where("area > 0"), rings.where("area < 0")
    counted = cut(outer.groupBy("component").agg(F.count(F.lit(1)).alias("exteriors"), F.min("ring").alias("owner")).where("exteriors = 1").select(F.col("component").alias("c2"), "owner"))
    sole = holes.join(counted, F.col("component").eqNullSafe(F.col("c2"))).select("component", "ring", "owner")
    rest = cut(holes.join(counted, F.col("component").eqNullSafe(F.col("c2")), "left_anti"))
    if rest.isEmpty():
        return sole
    cell = max(outer.agg(F.avg(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0], 10.0**-digits)
    points = rest.select("component", "ring", F.col("px").alias("x0"), F.col("py").alias("y0"), F.col("px").alias("x1"), F.col("py").alias("y1"))
    pairs = cut(box_join(points, outer.select("component", "ring", "area", "x0", "y0", "x1", "y1"), cell).where(F.col("l.component").eqNullSafe(F.col("r.component"))))
    band = lambda c: F.floor(c / cell)
    asked = pairs.select("l.component", F.col("l.ring").alias("ring"), F.col("l.x0").alias("hx"), F.col("l.y0").alias("hy"), F.col("r.ring").alias("owner"), F.col("r.area").alias("area"), band(F.col("l.y0")).alias("band"))
    unit, e = float(10**digits), F.col("e")
    sides = pieces_.select(F.col("component").alias("c2"), F.col("ring").alias("r2"), F.explode("edges").alias("e"))
    y0, y1 = e["ay"] / unit, e["by"] / unit
    sides = sides.select("c2", "r2", (e["ax"] / unit).alias("sx"), y0.alias("sy"), (e["bx"] / unit).alias("tx"), y1.alias("ty"), F.explode(F.sequence(band(F.least(y0, y1)), band(F.greatest(y0, y1)))).alias("b2"))
    met = asked.join(sides, F.col("component").eqNullSafe(F.col("c2")) & (F.col("owner") == F.col("r2")) & (F.col("band") == F.col("b2")))
    crosses = ((F.col("sy") > F.col("hy")) != (F.col("ty") > F.col("hy"))) & (F.col("hx") < (F.col("tx") - F.col("sx")) * (F.col("hy") - F.col("sy")) / (F.col("ty") - F.col("sy")) + F.col("sx"))
    inside = met.where(F.col("sy") != F.col("ty")).groupBy("component", "ring", "owner", "area").agg(F.sum(crosses.cast("int")).alias("n")).where("n % 2 = 1")
    least = inside.groupBy("component", "ring").agg(F.min(F.struct("area", "owner")).alias("o")).select("component", "ring", "o.owner")
    return sole.unionByName(least)


def polygons(edges: DataFrame, digits: int = DIGITS, block: int = BLOCK) -> DataFrame:
    """component, part, area, rings: the polygons that edges bound, holes after the exterior. Parts of a component touch in
    points at most. Points on straight edges go; a ring begins at its least point. Only the points of one polygon come
    together, in its own row. Edges that close no ring are left out. No edges give no polygons.
    """
    pieces_, _ = stored(closed_rings(edges, digits, block))
    rings = cut(ring_measures(pieces_, digits))
    own = F.when(F.col("area") > 0, F.col("ring")).alias("owner")
    owned = rings.where("area > 0").select("component", "ring", "area", own)
    if not rings.where("area < 0").isEmpty():
        found = owners(rings, pieces_, digits).withColumnsRenamed({"component": "c2", "ring": "r2"})
        on = F.col("component").eqNullSafe(F.col("c2")) & (F.col("ring") == F.col("r2"))
        owned = owned.unionByName(rings.where("area < 0").join(found, on).select("component", "ring", "area", "owner"))
    unit = float(10**digits)
    listed = pieces_.groupBy("component", "ring").agg(F.array_sort(F.collect_list(F.struct("nth", "edges"))).alias("all"))
    bent = F.filter(F.flatten(F.transform("all", lambda p: p["edges"])), bend)
    points = F.transform(bent, lambda e: F.struct((e["bx"] / unit).alias("x"), (e["by"] / unit).alias("y")))
    listed = listed.select(F.col("component").alias("c2"), F.col("ring").alias("r2"), points.alias("points")).withColumn("at", F.array_position("points", F.array_min("points")).cast("int"))
    turned = F.concat(F.expr("slice(points, at, size(points))"), F.expr("slice(points, 1, at - 1)"))
    rows = owned.join(listed, F.col("component").eqNullSafe(F.col("c2")) & (F.col("ring") == F.col("r2"))).select("component", "owner", "area", turned.alias("points"))
    made = rows.groupBy("component", "owner").agg(F.sum("area").alias("area"), F.array_sort(F.collect_list(F.struct((F.col("area") < 0).alias("hole"), "points"))).alias("r"))
    order = Window.partitionBy("component").orderBy(F.element_at("r", 1)["points"])
    return made.withColumn("part", F.row_number().over(order) - 1).select("component", "part", "area", F.transform("r", lambda x: x["points"]).alias("rings"))
