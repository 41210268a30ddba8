"""NumPy kernels on single tiles: neighbourhoods, distances, components, resampling and contours."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np


def disk(radius: int) -> list[tuple[int, int]]:
    """Offsets within a radius."""
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]


def overlaps(shape: tuple[int, ...], radius: int) -> Iterator[tuple[tuple, tuple]]:
    """For each offset of the disk the places of an image that have a pixel there, and those pixels."""
    h, w = shape[-2:]
    for i, j in disk(radius):
        if abs(i) < h and abs(j) < w:
            yield (..., slice(max(0, -i), min(h, h - i)), slice(max(0, -j), min(w, w - j))), (..., slice(max(0, i), min(h, h + i)), slice(max(0, j), min(w, w + j)))


@lru_cache(64)
def disk_count(height: int, width: int, radius: int) -> np.ndarray:
    """How many pixels of the disk exist around each pixel."""
    count = np.zeros((height, width))
    for to, _ in overlaps(count.shape, radius):
        count[to] += 1
    return count


def disk_mean(x: np.ndarray, radius: int) -> np.ndarray:
    """Mean over the disk, of the pixels that exist. x: an image or a stack of them, as below."""
    x = x.astype(float)
    total = np.zeros(x.shape)
    for to, at in overlaps(x.shape, radius):
        total[to] += x[at]
    return total / disk_count(*x.shape[-2:], radius)


def disk_max(x: np.ndarray, radius: int) -> np.ndarray:
    x = x.astype(float)
    out = x.copy()
    for to, at in overlaps(x.shape, radius):
        np.maximum(out[to], x[at], out=out[to])
    return out


def rescale(x: np.ndarray) -> np.ndarray:
    low, high = float(x.min()), float(x.max())
    if not high > low:
        raise ValueError("an image with one value can't be stretched")
    return (x - low) / (high - low)


def quantised(x: np.ndarray) -> np.ndarray:
    """x in 256 steps, as filters on 8-bit images see it."""
    return np.floor(np.clip(x, 0, 1) * 255)


def smooth(x: np.ndarray, radius: int = 2, quantize: bool = False) -> np.ndarray:
    """Disk mean, stretched to [0, 1]."""
    return rescale(np.floor(disk_mean(quantised(x), radius)) if quantize else disk_mean(x, radius))


def boundary(extent: np.ndarray, radius: int = 2) -> np.ndarray:
    """Pixels outside the extent within radius of it."""
    return ((disk_max(extent, radius) > 0) & (extent == 0)).astype(np.uint8)


def squared_distances(line: np.ndarray) -> np.ndarray:
    """Lower envelope of the parabolas line[k] + (x - k)**2 at each x."""
    n = len(line)
    out, places, cuts = np.empty(n), [], []
    for k in range(n):
        if not np.isfinite(line[k]):
            continue
        while places:
            p = places[-1]
            s = ((line[k] + k * k) - (line[p] + p * p)) / (2 * (k - p))
            if s > cuts[-1]:
                break
            places.pop()
            cuts.pop()
        cuts.append(s if places else -np.inf)
        places.append(k)
    if not places:
        return np.full(n, np.inf)
    j = 0
    for x in range(n):
        while j + 1 < len(places) and cuts[j + 1] < x:
            j += 1
        out[x] = line[places[j]] + (x - places[j]) ** 2
    return out


def distance(extent: np.ndarray) -> np.ndarray:
    """Euclidean distance of each pixel of the extent to the nearest one outside it; infinite if there is none."""
    f = np.where(extent > 0, np.inf, 0.0)
    f = np.apply_along_axis(squared_distances, 0, f)
    return np.sqrt(np.apply_along_axis(squared_distances, 1, f))


def label(extent: np.ndarray, eight: bool = True) -> np.ndarray:
    """Components of the extent: for each pixel 1 + the row-major index of the component's first pixel, 0 outside."""
    h, w = extent.shape
    parent = np.arange(h * w)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    steps = [(0, -1), (-1, 0)] + ([(-1, -1), (-1, 1)] if eight else [])
    for r, c in zip(*np.nonzero(extent), strict=True):
        for i, j in steps:
            if 0 <= r + i and 0 <= c + j < w and extent[r + i, c + j]:
                a, b = root(r * w + c), root((r + i) * w + c + j)
                parent[max(a, b)] = min(a, b)
    out = np.zeros(h * w, np.int64)
    for k in np.flatnonzero(extent.ravel()):
        out[k] = root(int(k)) + 1
    return out.reshape(h, w)


def normalised_distance(extent: np.ndarray) -> np.ndarray:
    """Distance divided by its greatest value in the component."""
    d, parts = distance(extent), label(extent)
    out = np.zeros(extent.shape, np.float32)
    for k in np.unique(parts[parts > 0]):
        own = parts == k
        out[own] = d[own] / d[own].max()
    return out


@lru_cache(64)
def cubic_weights(n: int, scale: int, a: float = -0.5) -> tuple[np.ndarray, np.ndarray]:
    """For each of n * scale places the four source pixels and their weights; half-pixel centres, edges renormalised."""
    x = (np.arange(n * scale) + 0.5) / scale - 0.5
    base = np.floor(x).astype(int)
    at = base[:, None] + np.arange(-1, 3)
    t = np.abs(x[:, None] - at)
    w = np.where(t <= 1, (a + 2) * t**3 - (a + 3) * t**2 + 1, np.where(t < 2, a * t**3 - 5 * a * t**2 + 8 * a * t - 4 * a, 0.0))
    w = np.where((at >= 0) & (at < n), w, 0.0)
    return np.clip(at, 0, n - 1), w / w.sum(axis=1, keepdims=True)


def bicubic(x: np.ndarray, scale: int) -> np.ndarray:
    """x enlarged by a whole factor, by separable cubic convolution."""
    at, w = cubic_weights(x.shape[-2], scale)
    y = sum(x[..., at[:, k], :] * w[:, k, None] for k in range(4))
    at, w = cubic_weights(x.shape[-1], scale)
    return sum(y[..., at[:, k]] * w[:, k] for k in range(4))


def upscale(x: np.ndarray, scale: int = 2) -> np.ndarray:
    return rescale(bicubic(x, scale))


def combine_upsample(extent: np.ndarray, edge: np.ndarray, scale: int = 2, radius: int = 2) -> np.ndarray:
    """Extent and boundary combined, enlarged and smoothed twice: scale**2 times the size."""
    x = smooth(upscale(np.clip(1 + extent - edge, 0, 2), scale), radius)
    return smooth(upscale(x, scale), radius * scale)


def smooth_upsample(x: np.ndarray, scale: int = 2, radius: int = 2, block: tuple[int, int, int] | None = None) -> np.ndarray:
    """What ``combine_upsample`` does to the combined image, without stretching it in between. Each step is a weighted mean,
    which a stretch before or after it leaves the same but for the stretch; so one at the end does for all. With a block
    (row, col, size in x) only that part of the result is given, and worked out in the last step."""
    x = bicubic(disk_mean(bicubic(x, scale), radius), scale)
    if block is None:
        return disk_mean(x, radius * scale)
    reach, square = radius * scale, scale * scale
    ends = [(k * square, min((k + block[2]) * square, n)) for k, n in zip(block[:2], x.shape[-2:], strict=True)]
    near = [(max(0, a - reach), min(n, b + reach)) for (a, b), n in zip(ends, x.shape[-2:], strict=True)]
    mean = disk_mean(x[(..., *(slice(a, b) for a, b in near))], reach)
    return mean[(..., *(slice(a - low, b - low) for (a, b), (low, _) in zip(ends, near, strict=True)))]


def upsample_reach(scale: int = 2, radius: int = 2) -> int:
    """How many pixels away a pixel still changes the result of ``smooth_upsample``, at most."""
    return 2 + -(-(radius + 2) // scale) + -(-radius * scale // (scale * scale)) + 1


def cloud_mask(probability: np.ndarray, average_over: int = 24, threshold: float = 0.4, dilation: int = 11) -> np.ndarray:
    """Smoothed cloud probability over a threshold, dilated."""
    mean = disk_mean(probability, average_over // 2) if average_over else probability
    mask = (mean > threshold).astype(float)
    return disk_max(mask, dilation // 2) > 0 if dilation else mask > 0


def rasterise(polygons: list[list[list[tuple[float, float]]]], height: int, width: int, inner: float = 0.0) -> np.ndarray:
    """1 where a pixel's centre (col + 0.5, row + 0.5) is in a polygon (even-odd over its rings) and at least ``inner``
    from its edges."""
    out = np.zeros((height, width), np.uint8)
    y, x = np.mgrid[0:height, 0:width] + 0.5
    for rings in polygons:
        hit, near = np.zeros((height, width), bool), np.full((height, width), np.inf)
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
                if ay != by:
                    hit ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
                if inner > 0:
                    n = (bx - ax) ** 2 + (by - ay) ** 2
                    t = np.clip(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / n, 0, 1) if n else 0.0
                    near = np.minimum(near, np.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)))
        out[hit & (near >= inner)] = 1
    return out


def contours(x: np.ndarray, threshold: float, outside: float | None = None) -> list[list[tuple[float, float]]]:
    """Closed rings (x, y) around what exceeds the threshold, by marching squares with linear crossing points.

    Pixel centres are at col + 0.5, row + 0.5. The image is surrounded by ``outside`` (below the threshold), so rings
    close at its edges. In a saddle the two high corners are kept apart. High ground is on the left of each ring.
    """
    low = threshold - 1.0 if outside is None else outside
    z = np.pad(x.astype(float), 1, constant_values=low)
    high = z > threshold
    out: dict[tuple, tuple] = {}

    def cross(r: int, c: int, dr: int, dc: int) -> tuple[float, float]:
        """The crossing on the edge from corner (r, c) to the next one."""
        a, b = z[r, c], z[r + dr, c + dc]
        t = (threshold - a) / (b - a)
        return (c - 0.5 + t * dc, r - 0.5 + t * dr)

    for r in range(z.shape[0] - 1):
        for c in range(z.shape[1] - 1):
            tl, tr, br, bl = high[r, c], high[r, c + 1], high[r + 1, c + 1], high[r + 1, c]
            if tl == tr == br == bl:
                continue
            top, right, bottom, left = ("h", r, c), ("v", r, c + 1), ("h", r + 1, c), ("v", r, c)
            corners = [(tl, left, top), (tr, top, right), (br, right, bottom), (bl, bottom, left)]  # clockwise
            n = sum((tl, tr, br, bl))
            if n == 2 and tl == br:  # saddle: a segment round each high corner
                for on, a, b in corners:
                    if on:
                        out[r, c, b] = (b, a)
                continue
            start = next(a for (on, a, _), (prev, _, _) in zip(corners, corners[-1:] + corners[:-1], strict=True) if on and not prev)
            stop = next(b for (on, _, b), (following, _, _) in zip(corners, corners[1:] + corners[:1], strict=True) if on and not following)
            out[r, c, stop] = (stop, start)
    follow = {a: b for a, b in out.values()}
    rings, seen = [], set()
    for edge in follow:
        if edge in seen:
            continue
        ring, at = [], edge
        while at not in seen:
            seen.add(at)
            kind, r, c = at
            ring.append(cross(r, c, 0, 1) if kind == "h" else cross(r, c, 1, 0))
            at = follow[at]
        rings.append(ring)
    return rings


def contour_segments(x: np.ndarray, threshold: float, outside: float | None = None) -> tuple[np.ndarray, ...]:
    """What ``contours`` puts together, as segments: row and col of the cell (its upper left pixel, -1 at the edges), ax,
    ay, bx, by. What exceeds the threshold is on the left, with x to the right and y up."""
    low = threshold - 1.0 if outside is None else outside
    z = np.pad(x.astype(float), 1, constant_values=low)
    rows, cols = np.mgrid[-1 : x.shape[0], -1 : x.shape[1]]
    corner = [z[:-1, :-1], z[:-1, 1:], z[1:, 1:], z[1:, :-1]]  # with y up, counter-clockwise
    high = [c > threshold for c in corner]
    along = lambda a, b: np.divide(threshold - a, b - a, out=np.full(a.shape, 0.5), where=a != b)
    tl, tr, br, bl = corner
    across = [(cols + 0.5 + along(tl, tr), rows + 0.5), (cols + 1.5, rows + 0.5 + along(tr, br)), (cols + 0.5 + along(bl, br), rows + 1.5), (cols + 0.5, rows + 0.5 + along(tl, bl))]
    out: list[tuple[np.ndarray, ...]] = []
    for first in range(4):
        for run in (1, 2, 3):  # high corners in a row, low ones before and after
            hit = ~high[first - 1] & ~high[(first + run) % 4]
            for k in range(run):
                hit = hit & high[(first + k) % 4]
            a, b = across[(first + run - 1) % 4], across[first - 1]
            out.append(tuple(np.broadcast_to(v, hit.shape)[hit] for v in (rows, cols, *a, *b)))
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))
