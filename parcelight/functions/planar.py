"""Planar geometry: polygons are lists of rings, rings lists of (x, y), the exterior first, not closed by a copy."""

from __future__ import annotations

import math

import numpy as np

Ring = list[tuple[float, float]]


def ring_area(ring: Ring) -> float:
    """Signed area: positive if counter-clockwise with y up."""
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, [*ring[1:], *ring[:1]], strict=True)) / 2


def area(rings: list[Ring]) -> float:
    return abs(ring_area(rings[0])) - sum(abs(ring_area(r)) for r in rings[1:]) if rings else 0.0


def centroid(ring: Ring) -> tuple[float, float]:
    a = ring_area(ring)
    if a == 0:
        return sum(x for x, _ in ring) / len(ring), sum(y for _, y in ring) / len(ring)
    pairs = list(zip(ring, [*ring[1:], *ring[:1]], strict=True))
    return tuple(sum((p[k] + q[k]) * (p[0] * q[1] - q[0] * p[1]) for p, q in pairs) / (6 * a) for k in (0, 1))


def bounds(rings: list[Ring]) -> tuple[float, float, float, float]:
    xs, ys = [x for r in rings for x, _ in r], [y for r in rings for _, y in r]
    return min(xs), min(ys), max(xs), max(ys)


def contains_point(rings: list[Ring], x: float, y: float) -> bool:
    """Even-odd over all rings."""
    hit = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], *ring[:1]], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
    return hit


def _side(a: tuple, b: tuple, c: tuple) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _on(a: tuple, b: tuple, c: tuple) -> bool:
    return min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])


def segments_meet(a: tuple, b: tuple, c: tuple, d: tuple) -> bool:
    p, q, r, s = _side(a, b, c), _side(a, b, d), _side(c, d, a), _side(c, d, b)
    if ((p > 0) != (q > 0)) and p and q and ((r > 0) != (s > 0)) and r and s:
        return True
    return any(v == 0 and _on(*e) for v, e in ((p, (a, b, c)), (q, (a, b, d)), (r, (c, d, a)), (s, (c, d, b))))


def intersects(p: list[Ring], q: list[Ring]) -> bool:
    """Whether two polygons share a point, edges included."""
    a, b = bounds(p), bounds(q)
    if a[0] > b[2] or b[0] > a[2] or a[1] > b[3] or b[1] > a[3]:
        return False
    edges = lambda rings: [(u, v) for r in rings for u, v in zip(r, [*r[1:], *r[:1]], strict=True)]
    mine = edges(p)
    if any(segments_meet(u, v, w, z) for w, z in edges(q) for u, v in mine):
        return True
    return contains_point(p, *q[0][0]) or contains_point(q, *p[0][0])


def contains(p: list[Ring], q: list[Ring]) -> bool:
    """Whether polygon q lies within p without crossing its edges."""
    edges = lambda rings: [(u, v) for r in rings for u, v in zip(r, [*r[1:], *r[:1]], strict=True)]
    proper = lambda a, b, c, d: _side(a, b, c) * _side(a, b, d) < 0 and _side(c, d, a) * _side(c, d, b) < 0
    if any(proper(u, v, w, z) for w, z in edges(q) for u, v in edges(p)):
        return False
    return all(contains_point(p, x, y) or any(_side(u, v, (x, y)) == 0 and _on(u, v, (x, y)) for u, v in edges(p)) for x, y in q[0])


def directed_edges(rings: list[Ring]) -> list[tuple]:
    """Edges (a, b) with the polygon on their left."""
    out = []
    for k, r in enumerate(rings):
        ring = r if (ring_area(r) > 0) == (k == 0) else r[::-1]
        out += [(a, b) for a, b in zip(ring, [*ring[1:], *ring[:1]], strict=True) if a != b]
    return out


def simplify(line: Ring, tolerance: float) -> Ring:
    """Douglas-Peucker on an open line; its ends stay."""
    if len(line) < 3:
        return line
    points = np.array(line, float)
    return [line[k] for k in kept_points(points[:, 0], points[:, 1], tolerance)]


def simplify_ring(ring: Ring, tolerance: float) -> Ring:
    """A ring cut at its first point and the one farthest from it; a result under three points leaves it as it is."""
    if len(ring) < 4:
        return ring
    far = max(range(len(ring)), key=lambda k: math.dist(ring[0], ring[k]))
    out = simplify(ring[: far + 1], tolerance)[:-1] + simplify([*ring[far:], ring[0]], tolerance)[:-1]
    return out if len(out) >= 3 else ring


def kept_of_rings(x: np.ndarray, y: np.ndarray, size: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points of many rings (size points each, one after the other) ``simplify_ring`` keeps."""
    size = np.asarray(size, np.int64)
    begin = np.cumsum(size) - size
    keep = np.repeat(size < 4, size)
    some = np.flatnonzero(size >= 4)
    if not len(some):
        return keep

    def places(a: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = np.repeat(np.arange(len(a)), n)
        return own, np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

    def greatest(own: np.ndarray, value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.cumsum(n) - n
        most = np.maximum.reduceat(value, start)
        hits = np.flatnonzero(value == most[own])
        return most, hits[np.searchsorted(own[hits], np.arange(len(n)))] - start  # the first one that is farthest

    own, at = places(begin[some], size[some])
    far = greatest(own, np.hypot(x[at] - x[begin[some]][own], y[at] - y[begin[some]][own]), size[some])[1]
    ring = np.concatenate((some, some))
    a, b = np.concatenate((np.zeros(len(some), np.int64), far)), np.concatenate((far, size[some]))
    keep[begin[some]] = keep[begin[some] + far] = True
    while len(ring):
        wide = b - a > 1
        ring, a, b = ring[wide], a[wide], b[wide]
        if not len(ring):
            break
        first, last = begin[ring] + a, begin[ring] + b % size[ring]
        own, at = places(first + 1, b - a - 1)
        dx, dy = x[last] - x[first], y[last] - y[first]
        n = np.hypot(dx, dy)
        px, py = x[at] - x[first][own], y[at] - y[first][own]
        with np.errstate(divide="ignore", invalid="ignore"):
            away = np.where(n[own] > 0, np.abs(dx[own] * py - dy[own] * px) / n[own], np.hypot(px, py))
        most, nth = greatest(own, away, b - a - 1)
        cut = most > tolerance
        ring, a, b, at = ring[cut], a[cut], b[cut], a[cut] + 1 + nth[cut]
        keep[begin[ring] + at] = True
        ring, a, b = np.concatenate((ring, ring)), np.concatenate((a, at)), np.concatenate((at, b))
    left = np.add.reduceat(keep[np.repeat(size > 0, size)].astype(np.int64), begin[size > 0])
    whole = np.zeros(len(size), bool)
    whole[size > 0] = left < 3
    return keep | np.repeat(whole, size)


def kept_points(x: np.ndarray, y: np.ndarray, tolerance: float, closed: bool = False, bent: bool = False) -> np.ndarray:
    """Places of the points of a line that Douglas and Peucker's method keeps. closed: the line ends where it begins, and
    keeps two more points; bent: it keeps one more if only its ends would be left."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True

    def farthest(a: int, b: int) -> tuple[float, int]:
        dx, dy = x[b] - x[a], y[b] - y[a]
        n = math.hypot(dx, dy)
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        d = np.abs(dx * py - dy * px) / n if n else np.hypot(px, py)
        return (float(d.max()), a + 1 + int(d.argmax())) if len(d) else (-1.0, -1)

    todo = [(0, len(x) - 1)]
    need = 2 if closed else int(bent)
    while todo:
        a, b = todo.pop()
        far, at = farthest(a, b)
        if at >= 0 and (far > tolerance or need > 0):
            need -= 1
            keep[at] = True
            parts = [(a, at), (at, b)]
            todo += sorted(parts, key=lambda p: farthest(*p)[0]) if need > 0 else parts
    return np.flatnonzero(keep)


#: WGS 84 and the UTM grid (fixed values).
SEMI_MAJOR, FLATTENING, SCALE, FALSE_EASTING, FALSE_NORTHING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0


def _series() -> tuple[float, list[float], list[float], float]:
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    back = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    return radius, forward, back, n


def to_utm(lon: float | np.ndarray, lat: float | np.ndarray, epsg: int) -> tuple:
    """Longitude and latitude to a UTM zone (EPSG 326xx or 327xx), by the transverse Mercator series of third order."""
    radius, forward, _, n = _series()
    phi, lam = np.radians(lat), np.radians(np.subtract(lon, epsg % 100 * 6 - 183))
    e = 2 * math.sqrt(n) / (1 + n)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x = eta + sum(a * np.cos(2 * k * xi) * np.sinh(2 * k * eta) for k, a in enumerate(forward, 1))
    y = xi + sum(a * np.sin(2 * k * xi) * np.cosh(2 * k * eta) for k, a in enumerate(forward, 1))
    return FALSE_EASTING + SCALE * radius * x, (FALSE_NORTHING if epsg // 100 == 327 else 0.0) + SCALE * radius * y


def from_utm(x: float | np.ndarray, y: float | np.ndarray, epsg: int) -> tuple:
    """UTM to longitude and latitude."""
    radius, _, back, n = _series()
    eta, xi = np.subtract(x, FALSE_EASTING) / (SCALE * radius), np.subtract(y, FALSE_NORTHING if epsg // 100 == 327 else 0.0) / (SCALE * radius)
    xp = xi - sum(b * np.sin(2 * k * xi) * np.cosh(2 * k * eta) for k, b in enumerate(back, 1))
    ep = eta - sum(b * np.cos(2 * k * xi) * np.sinh(2 * k * eta) for k, b in enumerate(back, 1))
    chi = np.arcsin(np.sin(xp) / np.cosh(ep))
    # the conformal latitude is turned back by iteration, to about a nanometre
    e, phi = 2 * math.sqrt(n) / (1 + n), chi
    for _ in range(8):
        phi = np.arcsin(np.tanh(np.arctanh(np.sin(chi)) + e * np.arctanh(e * np.sin(phi))))
    return epsg % 100 * 6 - 183 + np.degrees(np.arctan2(np.sinh(ep), np.cos(xp))), np.degrees(phi)


def moved(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple:
    """Points from one reference system to another: 4326 or UTM zones."""
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else from_utm(x, y, source)
    return (lon, lat) if target == 4326 else to_utm(lon, lat, target)


def reproject(rings: list[Ring], source: int, target: int) -> list[Ring]:
    """Rings from one reference system to another."""
    return [list(zip(*(v.tolist() for v in moved(*np.array(ring, float).T, source, target)), strict=True)) if ring else [] for ring in rings]
