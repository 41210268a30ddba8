"""What a crowd of shapes makes together, without making every pair of it.

Rows lie in the cells of nested grids, as in ``spatial.box_join``, and a cell's rows are looked at in rounds: the first
one, the next two, the next four and so on, each against what is still open in the cell. In a crowd most of it is settled
after a few rounds (linked, found or covered), so work grows with the rows and not with the pairs; where little meets,
cells are small. Many cells are worked on at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import overlay
from . import spatial
from .spatial import BOX

GROUP = ("grid", "cx", "cy")
#: Rows read at a time (whole cells), pairs of boxes and pairs of shapes looked at together.
ROWS, PAIRS, SHAPES = 1 << 14, 1 << 20, 1 << 15
#: Cells of a grid are 2^STEP times as large as those of the next: crowds need no small cells, and few grids few rows.
STEP = 3


def levels(layer: DataFrame, cell: float) -> list[int]:
    """The grids of a layer: one for each power of eight at most."""
    return sorted(r["n"] for r in layer.select(spatial.level(cell, STEP).alias("n")).where("n is not null").distinct().collect())


def cells(layer: DataFrame, cell: float, others: list[int]) -> DataFrame:
    return spatial.cells(layer, cell, others, STEP)


def boxes() -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in BOX]


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows as batches of whole groups, with the number of each row's group."""

    def numbers(t: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.cumsum(new)

    held, n, limit = [], 0, ROWS
    for b in batches:
        if b.num_rows:
            held, n = [*held, b], n + b.num_rows
        if n < limit:
            continue
        t = pa.concat_batches(held)
        g = numbers(t)
        last = int(np.searchsorted(g, g[-1]))
        if last:
            yield t.slice(0, last), g[:last]
        held, n = [t.slice(last)], t.num_rows - last
        limit = max(ROWS, 2 * n)
    if n:
        t = pa.concat_batches(held)
        yield t, numbers(t)


def rounds(group: np.ndarray, rows: np.ndarray, *order: np.ndarray) -> Iterator[np.ndarray]:
    """Of some rows the first of each group, the next two, the next four and so on, by the given order."""
    rows = rows[np.lexsort((*(k[rows] for k in reversed(order)), group[rows]))]
    own = group[rows]
    nth = np.floor(np.log2(np.arange(len(rows)) - np.searchsorted(own, own) + 1)).astype(np.int64)
    for k in range(int(nth.max(initial=-1)) + 1):
        yield rows[nth == k]


def cross(p: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in p and q (sorted groups) of all pairs in one group, about PAIRS at a time."""
    low = np.searchsorted(q, p)
    n = np.searchsorted(q, p, "right") - low
    work = np.cumsum(n)
    cuts = np.unique(np.concatenate(([0], np.searchsorted(work, np.arange(PAIRS, work[-1] if len(work) else 0, PAIRS)) + 1, [len(p)])))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if n[a:b].any():
            yield np.repeat(np.arange(a, b), n[a:b]), overlay.ranges(low[a:b], n[a:b])


def meet(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether boxes (columns x0, y0, x1, y1) share a point."""
    return (p[:, 0] <= q[:, 2]) & (q[:, 0] <= p[:, 2]) & (p[:, 1] <= q[:, 3]) & (q[:, 1] <= p[:, 3])


def boxed(t: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(box, whether a row is in the grid of its own size, an order in which large boxes come first)."""
    box = np.stack([t[c].to_numpy() for c in BOX], axis=1)
    own = t["level"].to_numpy() == t["grid"].to_numpy()
    return box, own, -(box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])


class Edges:
    """The edges of rows of polygons, taken as often as wanted."""

    def __init__(self, column: pa.Array) -> None:
        self.row, self.all = overlay.edges_of(column)
        self.n = np.bincount(self.row, minlength=len(column))
        self.first = np.cumsum(self.n) - self.n

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), self.n[rows]), self.all[overlay.ranges(self.first[rows], self.n[rows])]


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the least row of each set) where the sets of i and j are one."""
    label = label.copy()
    while len(i):
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        some = low != high
        i, j = i[some], j[some]
        np.minimum.at(label, high[some], low[some])
        while (label[label] != label).any():
            label = label[label]
    return label


def forest(layer: DataFrame, cell: float, key: str = "id", zone: str | None = None, shaped: bool = False) -> DataFrame:
    """Edges a < b (key: long) that link what all pairs would: rows whose boxes share a point (shaped: whose rings do), with
    a zone only those of different ones. No cell gives more edges than rows."""
    shape = [F.col("rings")] if shaped else []
    rows = layer.select(F.col(key).cast("long").alias("id"), *boxes(), *shape, (F.xxhash64(zone) if zone else F.lit(0).cast("long")).alias("zone"))
    rows = rows.where("size(rings) > 0") if shaped else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in groups(batches, GROUP):
            box, own, size = boxed(t)
            part, ids = t["zone"].to_numpy(), t["id"].to_numpy()
            edges = Edges(t["rings"]) if shaped else None
            label, pivot = np.arange(len(ids)), None
            for chosen in rounds(group, np.arange(len(ids)), ~own, size):
                pivot = chosen if pivot is None else pivot
                # what is linked to a cell's first row needs no more links to others that are
                rest = np.flatnonzero(label != label[pivot[group]]) if len(chosen) else chosen
                if not len(rest):
                    break
                for i, j in cross(group[rest], group[chosen]):
                    i, j = rest[i], chosen[j]
                    ok = (own[i] | own[j]) & (label[i] != label[j]) & meet(box[i], box[j])
                    ok &= (part[i] != part[j]) | (zone is None)
                    i, j = i[ok], j[ok]
                    for k in range(0, len(i), SHAPES):
                        a, b = i[k : k + SHAPES], j[k : k + SHAPES]
                        if shaped:
                            some = label[a] != label[b]
                            a, b = a[some], b[some]
                            some = overlay.share_point(overlay.Pairs(edges.of(a), edges.of(b), len(a)))
                            a, b = a[some], b[some]
                        label = joined(label, a, b)
            _, first, code = np.unique(ids, return_index=True, return_inverse=True)
            label = joined(label, np.arange(len(ids)), first[code])  # a row in several cells is one
            a, b = ids[first], ids[label[first]]
            some = a != b
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[some]), pa.array(np.maximum(a, b)[some])], ["a", "b"])

    placed = cells(rows, cell, levels(rows, cell)).repartition(*GROUP).sortWithinPartitions(*GROUP)
    return placed.mapInArrow(run, "a long, b long")


def first_met(left: DataFrame, right: DataFrame, cell: float, key: str = "id", order: str | None = None, value: str | None = None) -> DataFrame:
    """key, and the value of the right row that is first in order among those whose boxes meet it, for each left row that
    meets one. Without an order any one is taken, and only the key returned."""
    mine = left.select(F.col(key).alias("k"), *boxes())
    v = F.struct(F.col(order).alias("o"), F.col(value).alias("v")) if order else F.struct(F.lit(0).alias("o"))
    other = right.select(v.alias("v"), *boxes())
    a, b = levels(mine, cell), levels(other, cell)
    if not a or not b:
        mine, other = mine.where("false"), other.where("false")
    rows = cells(mine, cell, b or [0]).unionByName(cells(other, cell, a or [0]), allowMissingColumns=True)
    kind = lambda df, c: df.schema[c].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in groups(batches, GROUP):
            box, own, size = boxed(t)
            asks = np.asarray(t["v"].is_null())
            open_, i_, j_ = np.flatnonzero(asks), [], []
            by = [np.arange(t.num_rows)] if order else [~own, size]
            for chosen in rounds(group, np.flatnonzero(~asks), *by):
                best = np.full(t.num_rows, t.num_rows)
                for i, j in cross(group[open_], group[chosen]):
                    i, j = open_[i], chosen[j]
                    ok = (own[i] | own[j]) & meet(box[i], box[j])
                    np.minimum.at(best, i[ok], j[ok])
                done = best[open_] < t.num_rows
                i_.append(open_[done])
                j_.append(best[open_[done]])
                open_ = open_[~done]
                if not len(open_):
                    break
            i, j = (pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)) for x in (i_, j_))
            yield pa.RecordBatch.from_arrays([t["k"].take(i), t["v"].take(j)], ["k", "v"])

    placed = rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "v")
    found = placed.select("k", "v", *BOX, "level", *GROUP).mapInArrow(run, f"k {kind(mine, 'k')}, v {kind(other, 'v')}")
    if not order:
        return found.select(F.col("k").alias(key)).distinct()
    return found.groupBy(F.col("k").alias(key)).agg(F.min_by("v.v", "v.o").alias(value))


#: Rows of either side of a cell that meet in one place at most, and combinations of rows for each task.
BLOCK, WORK = 1 << 13, 1 << 25


def pairs(left: DataFrame, right: DataFrame, cell: float, key: str = "id", shaped: bool = False, area: float | None = None) -> DataFrame:
    """left_id, right_id of all pairs whose boxes share a point (shaped: whose rings do), as ``spatial.box_join`` and
    ``spatial.exact`` give them. With area (lines of a grid to 1, to which ends are rounded) also how much their rings share,
    without pairs that share none. Nothing else leaves a cell, so a pair costs no row of boxes and rings.

    Each row of the result is made, and they may grow with the square of the layers; tasks are as many as that work wants,
    and a cell with more than BLOCK rows of a side is cut into blocks, so none holds more."""
    shape = ["rings"] if shaped or area else []
    sides = [layer.select(F.col(key).alias("id"), *boxes(), *shape, F.lit(mine).alias("mine")) for layer, mine in ((left, True), (right, False))]
    found = [sorted(r["n"] for r in side.select(spatial.level(cell).alias("n")).where("n is not null").distinct().collect()) for side in sides]
    if not all(found):
        sides = [side.where("false") for side in sides]
    placed = spatial.cells(sides[0], cell, found[1] or [0]).unionByName(spatial.cells(sides[1], cell, found[0] or [0]))
    per = placed.groupBy(*GROUP).agg(F.count_if("mine").alias("p"), F.count_if(~F.col("mine")).alias("q")).where("p > 0 and q > 0")
    total = per.agg(F.sum(F.col("p").cast("double") * F.col("q")).alias("work"), F.max(F.greatest("p", "q")).alias("most")).first()
    n = max(4 * left.sparkSession.sparkContext.defaultParallelism, int((total["work"] or 0) // WORK))
    blocks = ("i", "j")
    if (total["most"] or 0) > BLOCK:
        count = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
        own = lambda c: F.array(F.pmod(F.xxhash64("id"), count(c)).cast("int"))
        every = lambda c: F.sequence(F.lit(0), count(c) - 1)
        rows = placed.join(per, [*GROUP])
        rows = rows.withColumn("i", F.explode(F.when(F.col("mine"), own("p")).otherwise(every("p"))))
        rows = rows.withColumn("j", F.explode(F.when(F.col("mine"), every("q")).otherwise(own("q")))).drop("p", "q")
    else:
        rows = placed.withColumns({c: F.lit(0) for c in blocks})
    keys = (*GROUP, *blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in groups(batches, keys):
            box, own, _ = boxed(t)
            mine = np.asarray(t["mine"])
            wide = 2.0 ** t["grid"].to_numpy() * cell
            at = [t[c].to_numpy() for c in ("cx", "cy")]
            rings = Shapes(t["rings"]) if shape else None
            p, q = np.flatnonzero(mine), np.flatnonzero(~mine)
            for i, j in cross(group[p], group[q]):
                i, j = p[i], q[j]
                ok = (own[i] | own[j]) & meet(box[i], box[j])
                i, j = i[ok], j[ok]
                for c in (0, 1):
                    ok = np.floor(np.maximum(box[i, c], box[j, c]) / wide[i]) == at[c][i]
                    i, j = i[ok], j[ok]
                if shaped:
                    ok = rings.share_point(i, j)
                    i, j = i[ok], j[ok]
                size = []
                if area:
                    share = rings.shared_area(i, j, area)
                    ok = share > 0
                    i, j, size = i[ok], j[ok], [pa.array(share[ok])]
                if len(i):
                    yield pa.RecordBatch.from_arrays([t["id"].take(pa.array(i)), t["id"].take(pa.array(j)), *size], names)

    names = ["left_id", "right_id", *(["area"] if area else [])]
    mine, other = (side.schema["id"].dataType.simpleString() for side in sides)
    wanted = rows.select("id", *BOX, *shape, "mine", "level", *keys).repartition(n, *keys).sortWithinPartitions(*keys)
    return wanted.mapInArrow(run, f"left_id {mine}, right_id {other}" + (", area double" if area else ""))


class Shapes:
    """Rows of polygons, compared as often as wanted. Those with upright and level edges only are taken apart into boxes once,
    and two of them share a point if two of their boxes do; others are compared edge by edge."""

    def __init__(self, column: pa.Array) -> None:
        self.edges = Edges(column)
        row, self.boxes, self.whole = overlay.slabs(self.edges.row, self.edges.all, len(column))
        self.n = np.bincount(row, minlength=len(column))
        self.first = np.cumsum(self.n) - self.n

    def combined(self, i: np.ndarray, j: np.ndarray, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pair, box, other box) of some of the pairs, about PAIRS combinations at a time."""
        work = np.cumsum(self.n[i[some]] * self.n[j[some]])
        for part in np.split(some, np.searchsorted(work, np.arange(PAIRS, work[-1] if len(work) else 0, PAIRS))):
            a, b = i[part], j[part]
            k, x = np.repeat(np.arange(len(part)), self.n[a]), overlay.ranges(self.first[a], self.n[a])
            m = self.n[b][k]
            yield part[np.repeat(k, m)], np.repeat(x, m), overlay.ranges(self.first[b][k], m)

    def shared_area(self, i: np.ndarray, j: np.ndarray, unit: float) -> np.ndarray:
        """How much rows i and j share, with corners rounded to a grid of so many lines to 1."""
        out = np.zeros(len(i))
        boxes, whole = np.round(self.boxes * unit), self.whole[i] & self.whole[j]
        for k, x, y in self.combined(i, j, np.flatnonzero(whole)):
            p, q = boxes[x], boxes[y]
            wide, high = (np.maximum(np.minimum(p[:, c + 2], q[:, c + 2]) - np.maximum(p[:, c], q[:, c]), 0) for c in (0, 1))
            np.add.at(out, k, wide * high / unit / unit)
        rest = np.flatnonzero(~whole)
        for k in range(0, len(rest), SHAPES):
            part = rest[k : k + SHAPES]
            out[part] = overlay.shared_area(overlay.Pairs(self.edges.of(i[part]), self.edges.of(j[part]), len(part)), unit)
        return out

    def share_point(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(i), bool)
        some = np.flatnonzero((self.n[i] > 0) & (self.n[j] > 0))
        hit[some] = meet(self.boxes[self.first[i[some]]], self.boxes[self.first[j[some]]])
        for k, x, y in self.combined(i, j, np.flatnonzero(~hit & (self.n[i] * self.n[j] > 1))):
            hit[k[meet(self.boxes[x], self.boxes[y])]] = True
        rest = np.flatnonzero(~hit & ~(self.whole[i] & self.whole[j]))
        for k in range(0, len(rest), SHAPES):
            part = rest[k : k + SHAPES]
            hit[part] = overlay.share_point(overlay.Pairs(self.edges.of(i[part]), self.edges.of(j[part]), len(part)))
        return hit


PIECE = ("t0", "t1", "x0", "y0", "x1", "y1")


def clipped(edges: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where edges enter and leave squares (0 to 1); what runs along a border belongs to the square above it or on its right."""
    begin, end = np.zeros(len(edges)), np.ones(len(edges))
    for c in (0, 1):
        p, d = edges[:, c], edges[:, c + 2] - edges[:, c]
        flat = d == 0
        with np.errstate(divide="ignore", invalid="ignore"):
            u, v = (low[:, c] - p) / d, (low[:, c] + size - p) / d
        begin = np.where(flat, begin, np.maximum(begin, np.minimum(u, v)))
        end = np.where(flat, np.where((low[:, c] <= p) & (p < low[:, c] + size), end, -1), np.minimum(end, np.maximum(u, v)))
    return begin, end


def reduced(u: np.ndarray, piece: np.ndarray, of: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edge, piece) of what is left of pieces (rows PIECE of edges u) without stretches of them: gone (rows PIECE) of piece
    number of."""
    order = np.lexsort((gone[:, 0], of))
    of, gone = of[order], gone[order]
    by = np.argsort(gone[:, 1], kind="stable")
    rank = np.empty(len(of), np.int64)
    rank[by] = np.arange(len(of))
    far = by[np.maximum.accumulate(of * len(of) + rank) - of * len(of)]  # the stretch that reached farthest so far
    new = np.concatenate(([True], of[1:] != of[:-1]))
    last = np.flatnonzero(np.concatenate((new[1:], [True])))
    before = np.concatenate(([0], far[:-1]))
    since = np.where(new[:, None], piece[of][:, [0, 2, 3]], gone[before][:, [1, 4, 5]])
    gaps = np.stack([since[:, 0], gone[:, 0], since[:, 1], since[:, 2], gone[:, 2], gone[:, 3]], axis=1)
    tail = gone[far[last]]
    rest = np.stack([tail[:, 1], piece[of[last], 1], tail[:, 4], tail[:, 5], piece[of[last], 4], piece[of[last], 5]], axis=1)
    whole = np.ones(len(u), bool)
    whole[of] = False
    u, piece = np.concatenate((u[whole], u[of], u[of[last]])), np.concatenate((piece[whole], gaps, rest))
    some = piece[:, 1] - piece[:, 0] > 1e-12
    u, piece = u[some], piece[some]
    order = np.lexsort((piece[:, 0], u))
    return u[order], piece[order]


def uncovered(layer: DataFrame, cell: float, sides: tuple[int, ...], covers: DataFrame | None = None) -> DataFrame:
    """component, ax, ay, bx, by: what other polygons leave of each polygon's edges. layer: id, component, box and rings.

    A piece goes if it is on such a side of another polygon of its component; of common pieces with both on one side the
    one with the least id is left. With covers (id, box, rings) these cover the layer, whatever the component, and take
    common pieces on one side as well. An edge is cut into its cells in each grid, and is left where all grids leave it.
    """
    apart = covers is not None
    rows = layer.where("size(rings) > 0").select("id", "component", *boxes(), "rings", F.lit(True).alias("cut"), F.xxhash64("id").alias("code"), (F.lit(0).cast("long") if apart else F.xxhash64("component")).alias("h"))
    others = levels(rows, cell)
    if apart:
        covers = covers.where("size(rings) > 0").select(*boxes(), "rings", F.lit(False).alias("cut"), F.lit(0).cast("long").alias("h"))
        there = levels(covers, cell)
        placed = cells(rows, cell, there).unionByName(cells(covers, cell, others), allowMissingColumns=True)
        others = there
    else:
        placed = cells(rows, cell, others)
    grids = F.lit(1) + F.size(F.filter(F.array(*[F.lit(n) for n in others]).cast("array<int>"), lambda n: n > F.col("level")))
    placed = placed.withColumn("grids", grids).repartition("h", *GROUP).sortWithinPartitions("h", *GROUP, "id")
    kind = lambda c: rows.schema[c].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in groups(batches, ("h", *GROUP)):
            box, own, size = boxed(t)
            cut, code = np.asarray(t["cut"]), t["code"].fill_null(0).to_numpy()
            edges = Edges(t["rings"])
            wide = 2.0 ** t["grid"].to_numpy() * cell
            low = np.stack([t[c].to_numpy() * wide for c in ("cx", "cy")], axis=1)
            u = np.flatnonzero(cut[edges.row])
            begin, end = clipped(edges.all[u], low[edges.row[u]], wide[edges.row[u]])
            some = end - begin > 1e-12
            u, begin, end = u[some], begin[some, None], end[some, None]
            a, b = edges.all[u][:, :2], edges.all[u][:, 2:]
            at = lambda k: np.where(k == 0, a, np.where(k == 1, b, a + k * (b - a)))
            piece = np.concatenate((begin, end, at(begin), at(end)), axis=1)
            for chosen in rounds(group, np.flatnonzero(~cut) if apart else np.arange(len(cut)), ~own, size):
                if not len(u):
                    break
                of, gone = [], []
                around = np.concatenate((np.minimum(piece[:, 2:4], piece[:, 4:]), np.maximum(piece[:, 2:4], piece[:, 4:])), axis=1)
                for i, j in cross(group[edges.row[u]], group[chosen]):
                    left, right = edges.row[u[i]], chosen[j]
                    ok = (own[left] | own[right]) & (apart | (code[left] != code[right])) & meet(around[i], box[right])
                    i, left, right = i[ok], left[ok], right[ok]
                    for k in range(0, len(i), SHAPES):
                        n, x, y = (v[k : k + SHAPES] for v in (i, left, right))
                        found = overlay.pieces(overlay.Pairs((np.arange(len(n)), edges.all[u[n]]), edges.of(y), len(n)))
                        pair = found["pair"].astype(np.int64)
                        goes = np.isin(found["side"], sides) | ((found["side"] == overlay.SAME) & (apart | (x > y)[pair]))
                        pair, own_ = pair[goes], piece[n[pair[goes]]]
                        new = np.stack([found[c][goes] for c in PIECE], axis=1)
                        early, late = new[:, 0] < own_[:, 0], new[:, 1] > own_[:, 1]
                        new[early] = np.where(np.isin(np.arange(6), (0, 2, 3)), own_, new)[early]
                        new[late] = np.where(np.isin(np.arange(6), (1, 4, 5)), own_, new)[late]
                        some = new[:, 1] - new[:, 0] > 1e-12
                        of.append(n[pair[some]])
                        gone.append(new[some])
                if sum(map(len, of)):
                    u, piece = reduced(u, piece, np.concatenate(of), np.concatenate(gone))
            row = edges.row[u]
            take = pa.array(row.astype(np.int64))
            number = (u - edges.first[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([t["id"].take(take), t["component"].take(take), pa.array(number), t["grids"].take(take), *map(pa.array, piece.T)], ["id", "component", "edge", "grids", *PIECE])

    wanted = placed.select("id", "component", *BOX, "rings", "cut", "code", "h", "level", *GROUP, "grids")
    parts = wanted.mapInArrow(run, f"id {kind('id')}, component {kind('component')}, edge int, grids int, {', '.join(f'{c} double' for c in PIECE)}")
    return everywhere(parts)


def everywhere(parts: DataFrame) -> DataFrame:
    """component, ax, ay, bx, by: the stretches of each edge (id, edge) that as many parts hold as it has grids."""
    point = lambda t, x, y, n: F.struct(F.col(t).alias("t"), F.lit(n).alias("n"), F.col(x).alias("x"), F.col(y).alias("y"))
    ends = parts.select("id", "component", "edge", "grids", F.explode(F.array(point("t0", "x0", "y0", 1), point("t1", "x1", "y1", -1))).alias("p"))
    edge = Window.partitionBy("id", "component", "edge")
    along = edge.orderBy("p.t", F.desc("p.n"), "p.x", "p.y")
    runs = ends.withColumns({"n": F.sum("p.n").over(along.rowsBetween(Window.unboundedPreceding, 0)), "q": F.lead("p").over(along)}).where("n >= grids and q.t - p.t > 1e-12")
    by = edge.orderBy("p.t")
    apart = F.coalesce(F.col("p.t") - F.lag("q.t").over(by) > 1e-12, F.lit(True))
    named = runs.withColumn("apart", apart).withColumn("run", F.sum(F.col("apart").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = named.groupBy("id", "component", "edge", "run").agg(F.min("p").alias("p"), F.max("q").alias("q"))
    return whole.select("component", F.col("p.x").alias("ax"), F.col("p.y").alias("ay"), F.col("q.x").alias("bx"), F.col("q.y").alias("by"))
