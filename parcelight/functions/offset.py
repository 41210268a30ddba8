"""Buffers of polygons: offset curves, cleaned by winding numbers, in numpy.

Every edge is moved to its right by the distance (to its left if that is negative). Where moved edges come apart an arc
joins them; elsewhere the curve goes back through the corner. The curve crosses itself; the buffer is where it winds
round at least once. So holes fill up, narrow places part and small polygons vanish without cases of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

from .overlay import crossing, ranges, side, within

#: How far beside a piece its winding numbers are taken.
ASIDE = 1e-6
#: Pairs of segments, and of points and segments, looked at together.
MANY = 1 << 18


def curve(edges: np.ndarray, ring: np.ndarray, distance: float, quarter: int) -> tuple[np.ndarray, np.ndarray]:
    """The raw offset curve of rings (edges ax, ay, bx, by in order, inside on the left; a ring's edges stand together):
    segments, and the edge each comes from. quarter: segments of a quarter circle."""
    n = np.arange(len(edges))
    last = np.append(ring[1:] != ring[:-1], True)[: len(n)]
    begin = np.flatnonzero(np.append(True, last[:-1])[: len(n)])
    after = n + 1
    after[last] = begin
    d = edges[:, 2:] - edges[:, :2]
    d = d / np.hypot(d[:, 0], d[:, 1])[:, None]
    normal = np.stack([d[:, 1], -d[:, 0]], axis=1) * distance
    turn = d[:, 0] * d[after, 1] - d[:, 1] * d[after, 0]
    corner = edges[:, 2:]
    leave, arrive = corner + normal, corner + normal[after]
    bent = turn * distance > 0
    back = ~bent
    out = [np.concatenate([edges[:, :2] + normal, leave], axis=1), np.concatenate([leave[back], corner[back]], axis=1), np.concatenate([corner[back], arrive[back]], axis=1)]
    a = np.arctan2(normal[bent, 1], normal[bent, 0])
    swept = (np.arctan2(normal[after[bent], 1], normal[after[bent], 0]) - a + math.pi) % (2 * math.pi) - math.pi
    steps = np.maximum(1, np.ceil(np.abs(swept) / (math.pi / 2 / quarter) - 1e-9)).astype(np.int64)
    own = np.repeat(np.arange(len(steps)), steps)
    nth = ranges(np.zeros(len(steps), np.int64), steps)

    def point(k: np.ndarray) -> np.ndarray:
        angle = (a[own] + swept[own] * k / steps[own])[:, None]
        on = corner[bent][own] + abs(distance) * np.concatenate([np.cos(angle), np.sin(angle)], axis=1)
        return np.where((k == 0)[:, None], leave[bent][own], np.where((k == steps[own])[:, None], arrive[bent][own], on))

    out.append(np.concatenate([point(nth), point(nth + 1)], axis=1))
    made, of = np.concatenate(out), np.concatenate([n, n[back], n[back], n[bent][own]])
    some = (made[:, 0] != made[:, 2]) | (made[:, 1] != made[:, 3])
    return made[some], of[some]


def portions(count: np.ndarray) -> Iterator[slice]:
    """Places in portions whose counts make about MANY together."""
    work = np.cumsum(count)
    cuts = np.unique(np.concatenate(([0], np.searchsorted(work, np.arange(MANY, work[-1] if len(work) else 0, MANY)), [len(count)])))
    yield from (slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def near_pairs(e: np.ndarray, shape: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places i < j of segments (of one shape, numbers from 0) whose boxes meet. They are looked for in strips, so that a large
    polygon's segments are not compared with all that lie above and below them, and a portion at a time."""
    shape = np.zeros(len(e), np.int64) if shape is None else shape
    x0, x1 = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    y0, y1 = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    n = np.maximum(np.bincount(shape), 1)
    low, high, left = np.full(len(n), np.inf), np.full(len(n), -np.inf), np.full(len(n), np.inf)
    np.minimum.at(low, shape, y0)
    np.maximum.at(high, shape, y1)
    np.minimum.at(left, shape, x0)
    height = np.maximum(np.maximum(2 * np.bincount(shape, y1 - y0) / n, np.where(high > low, high - low, 0) / n), 1e-9)
    first, last = (np.floor((v - low[shape]) / height[shape]).astype(np.int64) for v in (y0, y1))
    strips = np.zeros(len(n), np.int64)
    np.maximum.at(strips, shape, last + 1)
    own = np.repeat(np.arange(len(e)), last - first + 1)
    strip = ranges(first, last - first + 1) + (np.cumsum(strips) - strips)[shape[own]]
    begin, end = (v - left[shape] for v in (x0, x1))
    order = np.lexsort((begin[own], strip))
    own, strip = own[order], strip[order]
    first = first + (np.cumsum(strips) - strips)[shape]
    # segments of a strip that begin before this one ends
    wide = end.max() + 1
    upto = np.searchsorted(strip * wide + begin[own], strip * wide + end[own] + 1e-9 * wide, "right")
    upto = np.minimum(upto, np.searchsorted(strip, strip, "right"))
    n = np.arange(len(own))
    count = np.maximum(upto - n - 1, 0)
    i_, j_ = [], []
    for some in portions(count):
        k = np.repeat(n[some], count[some])
        i, j = own[k], own[ranges(n[some] + 1, count[some])]
        # a pair in several strips is taken in the first one
        hit = (x0[j] <= x1[i]) & (x0[i] <= x1[j]) & (y0[i] <= y1[j]) & (y0[j] <= y1[i]) & (strip[k] == np.maximum(first[i], first[j]))
        i_.append(np.minimum(i[hit], j[hit]))
        j_.append(np.maximum(i[hit], j[hit]))
    return np.concatenate(i_), np.concatenate(j_)


def winding(x: np.ndarray, y: np.ndarray, e: np.ndarray, point: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """How often the segments of its shape wind round each point, counter-clockwise. point and shape: the shapes of both."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    base = np.full(int(shape.max()) + 1, np.inf)
    np.minimum.at(base, shape, low)
    tall = float((high - base[shape]).max()) + 1
    pad = 1e-9 * tall * len(base)
    at = point * tall + np.clip(y - base[point], 0, tall)
    order = np.argsort(at, kind="stable")
    first = np.searchsorted(at[order], shape * tall + low - base[shape] - pad)
    last = np.searchsorted(at[order], shape * tall + high - base[shape] + pad, "right")
    out = np.zeros(len(x))
    for some in portions(last - first):
        n = (last - first)[some]
        k = np.repeat(np.arange(len(e))[some], n)
        at = order[ranges(first[some], n)]
        crosses = within(x[at], y[at], e[k]) & (point[at] == shape[k])
        out += np.bincount(at[crosses], np.where(e[k[crosses], 3] > e[k[crosses], 1], 1, -1), len(x))
    return out.astype(int)


def meetings(raw: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(segment, point) where segments i and j cross, and where one ends on the other."""
    s, t = side(raw[i], raw[j])
    u, v = side(raw[j], raw[i])
    proper = (np.sign(s) * np.sign(t) < 0) & (np.sign(u) * np.sign(v) < 0)
    point = crossing(raw[i[proper]], raw[j[proper]])
    cuts = [(i[proper], point), (j[proper], point)]
    for a, b, p, q in ((i, j, s, t), (j, i, u, v)):  # ends on other segments
        scale = 1e-12 + 1e-9 * np.hypot(raw[a, 2] - raw[a, 0], raw[a, 3] - raw[a, 1])
        for w, c in ((p, [0, 1]), (q, [2, 3])):
            on = np.abs(w) <= scale
            cuts.append((a[on], raw[b[on]][:, c]))
    return cuts


def buffered(edges: np.ndarray, ring: np.ndarray, distance: float, quarter: int = 16) -> np.ndarray:
    """Edges (inside on the left) of what is within a distance of a polygon; of what is farther than it from the outside, if
    it is negative."""
    return buffers(edges, ring, np.zeros(len(edges), np.int64), distance, quarter)[1]


def buffers(edges: np.ndarray, ring: np.ndarray, shape: np.ndarray, distance: float, quarter: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(polygon, edges) of the buffers of several polygons; shape: which one an edge is of, ring numbers are unlike."""
    raw, own = curve(edges, ring, distance, quarter)
    if not len(raw):
        return np.zeros(0, np.int64), raw
    own = shape[own]
    i, j = near_pairs(raw, own)
    cuts = [cut for k in range(0, len(i), MANY) for cut in meetings(raw, i[k : k + MANY], j[k : k + MANY])]
    del i, j
    every = np.arange(len(raw))
    edge = np.concatenate([c[0] for c in cuts] + [every, every])
    point = np.concatenate([c[1] for c in cuts] + [raw[:, :2], raw[:, 2:]])
    d = raw[:, 2:] - raw[:, :2]
    place = ((point - raw[edge, :2]) * d[edge]).sum(axis=1) / (d[edge] ** 2).sum(axis=1)
    some = (place >= 0) & (place <= 1)
    edge, place, point = edge[some], place[some], point[some]
    order = np.lexsort((place, edge))
    edge, place, point = edge[order], place[order], point[order]
    del cuts, d, some, order
    part = np.flatnonzero((edge[1:] == edge[:-1]) & (place[1:] - place[:-1] > 1e-12))
    a, b, mine = point[part], point[part + 1], own[edge[part]]
    length = np.hypot(*(b - a).T)
    a, b, mine, length = a[length > 0], b[length > 0], mine[length > 0], length[length > 0]
    middle, normal = (a + b) / 2, np.stack([a[:, 1] - b[:, 1], b[:, 0] - a[:, 0]], axis=1) / length[:, None] * ASIDE
    left, right = (winding(*(middle + k * normal).T, raw, mine, own) for k in (1, -1))
    kept = (left > 0) & (right <= 0)
    order = np.argsort(mine[kept], kind="stable")
    return mine[kept][order], np.concatenate([a[kept], b[kept]], axis=1)[order]
