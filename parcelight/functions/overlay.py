"""Overlays of polygons in numpy, many pairs at a time: where edges of one lie in the other.

Edges are rows ax, ay, bx, by with the polygon on their left. Points in which edges cross are worked out in the same way
whichever of the two is cut, and a corner that lies on an edge is taken as it is; so pieces of both end in equal points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: What lies to a piece's left and right, as seen from the other polygon.
OUTSIDE, INSIDE, SAME, OPPOSITE = 0, 1, 2, 3
#: Corners this near to an edge lie on it.
NEAR = 1e-7
#: Pairs of edges looked at together.
MANY = 1 << 20


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for length[0] numbers, then those of the next."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def edges_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(polygon, edges) of an array of polygons (lists of rings of points): exteriors run counter-clockwise, holes
    clockwise. Null and empty ones have no edges."""
    shape, _, edges = ring_edges(column)
    return shape, edges


def ring_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As edges_of, with the number of the ring in between; a ring's edges follow one another."""
    rings = column.flatten()
    shape = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths().fill_null(0)))
    size = np.asarray(rings.value_lengths().fill_null(0)).astype(np.int64)
    points = rings.flatten()
    x, y = (np.asarray(points.field(k), float) for k in (0, 1))
    end = np.cumsum(size)
    ring = np.repeat(np.arange(len(size)), size)
    n = np.arange(len(x))
    following = np.where(n + 1 == end[ring], (end - size)[ring], n + 1) if len(n) else n
    out = np.stack([x, y, x[following], y[following]], axis=1)
    area = np.zeros(len(size))
    np.add.at(area, ring, (out[:, 0] - out[:, 2]) * (out[:, 1] + out[:, 3]))
    first = np.concatenate(([True], shape[1:] != shape[:-1])) if len(shape) else np.zeros(0, bool)
    turn = ((area > 0) != first)[ring]
    back = np.where(turn, (end - 1 + end - size)[ring] - n, n) if len(n) else n  # rings that run the other way, from their end
    out = np.where(turn[:, None], out[back][:, [2, 3, 0, 1]], out)
    some = (out[:, 0] != out[:, 2]) | (out[:, 1] != out[:, 3])
    return shape[ring][some], ring[some], out[some]


def lists(like: pa.Array, size: np.ndarray, values: pa.Array) -> pa.Array:
    """Lists of so many values, null where like is."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), values, mask=like.is_null() if like.null_count else None)


def with_points(column: pa.Array, x: np.ndarray, y: np.ndarray) -> pa.Array:
    """Polygons with other points, as many in each ring."""
    rings = column.flatten()
    size = lambda like: np.asarray(like.value_lengths().fill_null(0))
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
    return lists(column, size(column), lists(rings, size(rings), points)).cast(column.type)


class Pairs:
    """Pairs of polygons: edges of the k-th first one are p[p0[k]:p0[k]+pn[k]], and q alike."""

    def __init__(self, p: tuple[np.ndarray, np.ndarray], q: tuple[np.ndarray, np.ndarray], n: int) -> None:
        (self.pk, self.p), (self.qk, self.q), self.n = p, q, n
        self.pn, self.qn = np.bincount(self.pk, minlength=n), np.bincount(self.qk, minlength=n)
        self.p0, self.q0 = np.cumsum(self.pn) - self.pn, np.cumsum(self.qn) - self.qn

    def turned(self) -> Pairs:
        return Pairs((self.qk, self.q), (self.pk, self.p), self.n)

    def parts(self) -> list[Pairs]:
        """The pairs in portions whose edges make about MANY combinations."""
        work = np.cumsum(self.pn.astype(float) * self.qn)
        cuts = np.unique(np.concatenate(([0], np.searchsorted(work, np.arange(MANY, work[-1] if len(work) else 0, MANY)), [self.n])))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            i, j = (self.pk >= a) & (self.pk < b), (self.qk >= a) & (self.qk < b)
            out.append((int(a), Pairs((self.pk[i] - a, self.p[i]), (self.qk[j] - a, self.q[j]), int(b - a))))
        return out


def side(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the signed areas of edge a with the first and with the second end of edge b."""
    dx, dy = a[:, 2] - a[:, 0], a[:, 3] - a[:, 1]
    return dx * (b[:, 1] - a[:, 1]) - dy * (b[:, 0] - a[:, 0]), dx * (b[:, 3] - a[:, 1]) - dy * (b[:, 2] - a[:, 0])


def crossing(e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """The points in which lines e and f cross, the same for (e, f), (f, e) and edges turned round."""

    def ordered(v: np.ndarray) -> np.ndarray:
        swap = (v[:, 0] > v[:, 2]) | ((v[:, 0] == v[:, 2]) & (v[:, 1] > v[:, 3]))
        return np.where(swap[:, None], v[:, [2, 3, 0, 1]], v)

    e, f = ordered(e), ordered(f)
    differ = e != f
    at = np.argmax(differ, axis=1)
    row = np.arange(len(e))
    swap = e[row, at] > f[row, at]
    e, f = np.where(swap[:, None], f, e), np.where(swap[:, None], e, f)
    s, t = side(f, e)
    with np.errstate(divide="ignore", invalid="ignore"):
        u = s / (s - t)
    return np.stack([e[:, 0] + u * (e[:, 2] - e[:, 0]), e[:, 1] + u * (e[:, 3] - e[:, 1])], axis=1)


def within(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Whether a ray from (x, y) to the right crosses edge e."""
    up = (e[:, 1] > y) != (e[:, 3] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        return up & (x < (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0])


def pieces(pairs: Pairs) -> dict[str, np.ndarray]:
    """The edges of the first polygons, cut where they meet the second ones: pair, edge (a row of p), t0, t1 (along the
    edge, 0 to 1), x0, y0, x1, y1, side."""
    made = [_pieces(part) | {"at": (k, part)} for k, part in pairs.parts()]
    out = {}
    shift = 0
    for m in made:
        k, part = m.pop("at")
        m["pair"], m["edge"] = m["pair"] + k, m["edge"] + shift
        shift += len(part.p)
    for c in ("pair", "edge", "t0", "t1", "x0", "y0", "x1", "y1", "side"):
        out[c] = np.concatenate([m[c] for m in made]) if made else np.zeros(0)
    return out


def _pieces(k: Pairs) -> dict[str, np.ndarray]:
    count = k.qn[k.pk]
    first = np.cumsum(count) - count
    i, j = np.repeat(np.arange(len(k.p)), count), ranges(k.q0[k.pk], count)
    e, f = k.p[i], k.q[j]
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    square = dx * dx + dy * dy
    s, t = side(e, f)
    along = lambda x, y: ((x - e[:, 0]) * dx + (y - e[:, 1]) * dy) / square
    u, v = along(f[:, 0], f[:, 1]), along(f[:, 2], f[:, 3])
    on_s, on_t = (np.abs(v) <= NEAR * np.sqrt(square) for v in (s, t))
    flat = on_s & on_t
    low, high, same = np.minimum(u, v), np.maximum(u, v), v > u
    # where the other edge's ends lie on this one, and where the two cross
    cuts = [(i[m], w[m], f[m][:, c]) for m, w, c in ((on_s, u, [0, 1]), (on_t, v, [2, 3]))]
    proper = ~on_s & ~on_t & ((s > 0) != (t > 0))
    at = crossing(e[proper], f[proper])
    cuts.append((i[proper], ((at[:, 0] - e[proper, 0]) * dx[proper] + (at[:, 1] - e[proper, 1]) * dy[proper]) / square[proper], at))
    every = np.arange(len(k.p))
    edge = np.concatenate([c[0] for c in cuts] + [every, every])
    place = np.concatenate([c[1] for c in cuts] + [np.zeros(len(every)), np.ones(len(every))])
    point = np.concatenate([c[2] for c in cuts] + [k.p[:, :2], k.p[:, 2:]])
    own = np.concatenate((np.zeros(len(edge) - 2 * len(every), bool), np.ones(2 * len(every), bool)))
    some = own | ((place > 1e-12) & (place < 1 - 1e-12))
    edge, place, point = edge[some], place[some], point[some]
    order = np.lexsort((place, edge))
    edge, place, point = edge[order], place[order], point[order]
    fresh = np.concatenate(([True], (edge[1:] != edge[:-1]) | (place[1:] - place[:-1] > 1e-12))) if len(edge) else np.zeros(0, bool)
    edge, place, point = edge[fresh], place[fresh], point[fresh]
    part = np.flatnonzero(edge[1:] == edge[:-1])
    edge, t0, t1, a, b = edge[part], place[part], place[part + 1], point[part], point[part + 1]
    # each piece against all edges of the other polygon
    count = k.qn[k.pk[edge]]
    n = np.repeat(np.arange(len(edge)), count)
    combo = ranges(first[edge], count)
    m = ((t0 + t1) / 2)[n]
    lies = flat[combo] & (low[combo] < m) & (m < high[combo])
    with_it, against = (np.bincount(n[lies & (same[combo] == way)], minlength=len(edge)) for way in (True, False))
    x, y = (k.p[edge][:, c] + (t0 + t1) / 2 * (k.p[edge][:, c + 2] - k.p[edge][:, c]) for c in (0, 1))
    inside = np.bincount(n[within(x[n], y[n], f[combo])], minlength=len(edge)) % 2 == 1
    found = np.where(against > 0, OPPOSITE, np.where(with_it > 0, SAME, np.where(inside, INSIDE, OUTSIDE)))
    return {"pair": k.pk[edge], "edge": edge, "t0": t0, "t1": t1, "x0": a[:, 0], "y0": a[:, 1], "x1": b[:, 0], "y1": b[:, 1], "side": found}


def shared_edges(pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """(pair, edges) that bound what the polygons of each pair share: the pieces of each that lie in the other, and common
    pieces."""
    p, q = pieces(pairs), pieces(pairs.turned())
    keep = [np.isin(p["side"], (INSIDE, SAME)), q["side"] == INSIDE]
    pair = np.concatenate([f["pair"][k] for f, k in zip((p, q), keep, strict=True)]).astype(np.int64)
    return pair, np.stack([np.concatenate([f[c][k] for f, k in zip((p, q), keep, strict=True)]) for c in ("x0", "y0", "x1", "y1")], axis=1)


def shared_area(pairs: Pairs, unit: float) -> np.ndarray:
    """How much the polygons of each pair share, from edges rounded to a grid of so many lines to 1."""
    pair, e = shared_edges(pairs)
    e = np.round(e * unit)
    first = np.zeros((pairs.n, 2))  # strips are reckoned from a point of the pair's own, so far places lose no digits
    first[pair] = e[:, :2]
    x0, y0, x1, y1 = (e - np.tile(first[pair], 2)).T
    return np.bincount(pair, (x0 - x1) * (y0 + y1), pairs.n) / 2 / unit / unit


def share_point(pairs: Pairs) -> np.ndarray:
    """Whether the polygons of each pair share a point, edges included."""
    out = np.zeros(pairs.n, bool)
    for first, k in pairs.parts():
        count = k.qn[k.pk]
        i, j = np.repeat(np.arange(len(k.p)), count), ranges(k.q0[k.pk], count)
        e, f = k.p[i], k.q[j]
        (p, q), (r, s) = side(e, f), side(f, e)
        boxes = np.ones(len(e), bool)
        for c in (0, 1):
            boxes &= np.minimum(e[:, c], e[:, c + 2]) <= np.maximum(f[:, c], f[:, c + 2])
            boxes &= np.minimum(f[:, c], f[:, c + 2]) <= np.maximum(e[:, c], e[:, c + 2])
        hit = np.zeros(k.n, bool)
        hit[k.pk[i[boxes & (np.sign(p) * np.sign(q) <= 0) & (np.sign(r) * np.sign(s) <= 0)]]] = True
        # one may lie in the other. The first may be a part of an area and fall into several rings: any corner of it counts
        odd = np.bincount(i[within(e[:, 0], e[:, 1], f)], minlength=len(k.p)) % 2 == 1
        hit[k.pk[odd]] = True
        some = np.flatnonzero((k.pn > 0) & (k.qn > 0))
        corner = k.q[k.q0[some]]
        rows, at = np.repeat(np.arange(len(some)), k.pn[some]), ranges(k.p0[some], k.pn[some])
        odd = np.bincount(rows[within(corner[rows, 0], corner[rows, 1], k.p[at])], minlength=len(some)) % 2 == 1
        hit[some[odd]] = True
        out[first : first + k.n] = hit
    return out


def slabs(row: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, boxes, whole): polygons whose edges are all upright or level, as boxes between the heights of their corners;
    and which of n rows these make up whole, edges included. Other rows have no boxes. Rows are sorted."""
    upright, flat = edges[:, 0] == edges[:, 2], edges[:, 1] == edges[:, 3]
    straight = np.zeros(n, bool)
    straight[row] = True
    straight[row[~upright & ~flat]] = False
    v = np.flatnonzero(upright & straight[row])
    low, high = np.minimum(edges[v, 1], edges[v, 3]), np.maximum(edges[v, 1], edges[v, 3])
    owner, y = np.concatenate((row[v], row[v])), np.concatenate((low, high))
    order = np.lexsort((y, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order[1:]] != owner[order[:-1]]) | (y[order[1:]] != y[order[:-1]])
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new) - 1
    height = y[order[new]]
    begin, end = name[: len(v)], name[len(v) :]
    k, slab = np.repeat(np.arange(len(v)), end - begin), ranges(begin, end - begin)
    x = edges[v[k], 0]
    order = np.lexsort((x, slab))
    k, slab, x = k[order[::2]], slab[order[::2]], x[order].reshape(-1, 2)  # upright edges of a slab come in pairs
    own = row[v[k]]
    boxes = np.stack([x[:, 0], height[slab], x[:, 1], height[slab + 1]], axis=1)
    order = np.argsort(own, kind="stable")
    own, boxes = own[order], boxes[order]
    # a level edge that no single box holds, such as a spike, is no part of what the boxes make up
    f = np.flatnonzero(flat & straight[row])
    count = np.bincount(own, minlength=n)
    m = count[row[f]]
    k, b = np.repeat(np.arange(len(f)), m), boxes[ranges((np.cumsum(count) - count)[row[f]], m)]
    e = edges[f[k]]
    held = (b[:, 0] <= np.minimum(e[:, 0], e[:, 2])) & (np.maximum(e[:, 0], e[:, 2]) <= b[:, 2]) & (b[:, 1] <= e[:, 1]) & (e[:, 1] <= b[:, 3])
    whole = straight.copy()
    whole[row[f[np.bincount(k[held], minlength=len(f)) == 0]]] = False
    return own, boxes, whole


def covers(pairs: Pairs) -> np.ndarray:
    """Whether the first polygon of each pair holds all of the second, common edges allowed."""
    mine, other = pieces(pairs.turned()), pieces(pairs)
    out = pairs.qn > 0
    out[mine["pair"][(mine["side"] == OUTSIDE) | (mine["side"] == OPPOSITE)].astype(int)] = False
    out[other["pair"][other["side"] == INSIDE].astype(int)] = False
    return out & (pairs.pn > 0)


def corners_on(pairs: Pairs) -> tuple[np.ndarray, ...]:
    """(pair, edge, t, points): the second polygons' corners that lie on edges of the first ones, between their ends."""
    out, shift = [], 0
    for first, k in pairs.parts():
        count = k.qn[k.pk]
        i, j = np.repeat(np.arange(len(k.p)), count), ranges(k.q0[k.pk], count)
        e, f = k.p[i], k.q[j]
        dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
        square = dx * dx + dy * dy
        t = ((f[:, 0] - e[:, 0]) * dx + (f[:, 1] - e[:, 1]) * dy) / square
        hit = (np.abs(side(e, f)[0]) <= NEAR * np.sqrt(square)) & (t > 1e-12) & (t < 1 - 1e-12)
        out.append((first + k.pk[i[hit]], shift + i[hit], t[hit], f[hit, :2]))
        shift += len(k.p)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 2))
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))
