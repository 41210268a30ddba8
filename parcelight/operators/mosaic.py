"""Mosaics of overlapping tiles: edge weights, placement in a global grid, weighted averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edge_weight(row: Column, col: Column, height: int, width: int, buffer: tuple[int, int], drift: bool = False) -> Column:
    """Weight of a pixel: a ramp over 2 * buffer from 0 at each edge to 1.

    drift gives the top ramp another form, which also rises along the row: floor((i * width + j) / ramp) / (width - 1).
    """
    ramp = lambda b: F.lit(float(2 * b - 1))
    b0, b1 = buffer
    across = F.when(col < 2 * b0, col / ramp(b0)).when(col >= width - 2 * b0, (F.lit(width - 1) - col) / ramp(b0)).otherwise(F.lit(1.0))
    top = F.floor((row * width + col) / F.lit(2 * b1)) / F.lit(float(width - 1)) if drift else row / ramp(b1)
    down = F.when(row < 2 * b1, top).when(row >= height - 2 * b1, (F.lit(height - 1) - row) / ramp(b1)).otherwise(F.lit(1.0))
    return across * down


def place(pixels: DataFrame, tile_row: Column, tile_col: Column, step: int) -> DataFrame:
    """Pixels with their place in the global grid, for tiles that begin every step pixels."""
    return pixels.withColumns({"g_row": tile_row * step + F.col("row"), "g_col": tile_col * step + F.col("col")})


def overlap_average(placed: DataFrame, keys: list[str], value: str, weight: str, no_data: float | None = None, round_output: bool = False) -> DataFrame:
    """One value for each global pixel: the weighted mean of several sources with weight, else the plain mean of what is
    there, else null."""
    p = F.col(value) if no_data is None else F.when(F.col(value) != no_data, F.col(value))
    n, total, w = F.count(p), F.sum(p), F.sum(F.when(p.isNotNull(), F.col(weight)))
    mean = F.when((n > 1) & (w > 0), F.sum(p * F.col(weight)) / w).when(n > 0, total / n)
    return placed.groupBy(*keys).agg((F.bround(mean, 0) if round_output else mean).alias("value"), n.alias("n"))


def read_window(mosaic: DataFrame, row: int, col: int, size: int, row_name: str = "g_row", col_name: str = "g_col") -> DataFrame:
    """The pixels of a window, with coordinates from its corner."""
    inside = F.col(row_name).between(row, row + size - 1) & F.col(col_name).between(col, col + size - 1)
    return mosaic.where(inside).withColumns({"row": F.col(row_name) - row, "col": F.col(col_name) - col})


def chunks(rasters: DataFrame, size: int, overlap: int) -> DataFrame:
    """Rasters (h, w and whatever else) with row and col, the corners of the chunks that cover them, every size - overlap
    pixels. A chunk that would only hold the overlap at the right edge is left out; a raster without columns has one chunk
    for each row of chunks, one without rows none."""
    step = size - overlap
    rows = rasters.where("h > 0").withColumn("row", F.explode(F.sequence(F.lit(0), F.col("h") - 1, F.lit(step))))
    return rows.withColumn("col", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("w") - 1), F.lit(step)))).where(F.col("col") <= F.greatest(F.lit(0), F.col("w") - overlap))
