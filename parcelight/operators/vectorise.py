"""From probability rasters to parcel polygons.

Each block gives the boundary segments of its own cells. Segments of neighbouring blocks meet in the same points, since
both work them out from the same two pixels; rings are put together from segments (``rings``), so no polygon is stitched
or merged, none has to fit into a block or a task, and the result does not depend on the size of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels, planar
from . import focal, rings


def contour_rings(tiles: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """keys, ring number, signed area (negative: a hole) and points of each ring around values over the threshold."""
    kinds = dict(tiles.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "ring int, ring_area double, points array<struct<x: double, y: double>>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (p for whole in batches for p in focal.portions(whole, 16)):
            out = []
            for row in b.itertuples(index=False):
                x = np.asarray(row.px, float).reshape(row.h, row.w)
                for n, ring in enumerate(kernels.contours(x, threshold)):
                    out.append((*(getattr(row, k) for k in keys), n, -planar.ring_area(ring), [{"x": p, "y": q} for p, q in ring]))
            yield pd.DataFrame(out, columns=[*keys, "ring", "ring_area", "points"])

    return tiles.select(*keys, "h", "w", "px").mapInPandas(run, schema)


def contour_edges(blocks: DataFrame, key: str, threshold: float, size: int) -> DataFrame:
    """component (the key), ax, ay, bx, by: the boundary of what exceeds the threshold, in raster coordinates (x = column).

    blocks: key, block_row, block_col, top, left, h, w, px; size x size pixels with a halo of one. A cell of four pixels
    belongs to the block of its upper left one; those beyond the upper and left edge belong to the first blocks. Pixels
    that no block has are low.
    """
    schema = f"component {dict(blocks.dtypes)[key]}, ax double, ay double, bx double, by double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n, m, top, left, h, w = (b[c][i].as_py() for c in ("block_row", "block_col", "top", "left", "h", "w"))
                r, c, *xy = kernels.contour_segments(np.asarray(b["px"][i].values, float).reshape(h, w), threshold)
                own = lambda at, k: (at // size == k) | ((at < 0) & (k == 0))
                mine = own(r + top, n) & own(c + left, m)
                component = b["component"].take(pa.array(np.full(int(mine.sum()), i)))
                yield pa.RecordBatch.from_arrays([component, *[pa.array(v[mine] + by) for v, by in zip(xy, (left, top) * 2, strict=True)]], ["component", *rings.XY])

    return blocks.select(F.col(key).alias("component"), "block_row", "block_col", "top", "left", "h", "w", "px").mapInArrow(run, schema)


def parcels(blocks: DataFrame, key: str, threshold: float, size: int, digits: int = rings.DIGITS) -> DataFrame:
    """key, part, area, rings (exterior first) of what exceeds the threshold, in raster coordinates. In a saddle high ground
    is kept apart."""
    return rings.polygons(contour_edges(blocks, key, threshold, size), digits).withColumnRenamed("component", key)
