"""Neighbourhood operators: a relational form over pixel rows, and a tile form that runs a NumPy kernel on each image.

The relational form sends each pixel to the places it influences and aggregates there: one explode and one group, no
join. It suits small radii; its rows grow with the disk. The tile form keeps an image in one row, so a radius costs no
rows, and images are spread over tasks; large rasters are cut into blocks with a halo first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels


def _spread(pixels: DataFrame, image: str, value: str, radius: int, height: int, width: int) -> DataFrame:
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in kernels.disk(radius)])
    out = pixels.select(image, F.col("row").alias("r"), F.col("col").alias("c"), value, F.explode(steps).alias("s"))
    out = out.select(image, (F.col("r") + F.col("s.i")).alias("row"), (F.col("c") + F.col("s.j")).alias("col"), value)
    return out.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))


def disk_mean(pixels: DataFrame, image: str, value: str, radius: int, height: int, width: int) -> DataFrame:
    return _spread(pixels, image, value, radius, height, width).groupBy(image, "row", "col").agg(F.avg(value).alias("mean"))


def disk_max(pixels: DataFrame, image: str, value: str, radius: int, height: int, width: int) -> DataFrame:
    return _spread(pixels, image, value, radius, height, width).groupBy(image, "row", "col").agg(F.max(value).alias("dilated"))


def boundary(pixels: DataFrame, image: str, extent: str, radius: int, height: int, width: int) -> DataFrame:
    """Pixels outside the extent within radius of it: the dilated extent, joined to nothing but its own pixel."""
    own = F.struct("row", "col", extent)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in kernels.disk(radius)])
    spread = pixels.select(image, own.alias("p"), F.explode(steps).alias("s")).select(image, (F.col("p.row") + F.col("s.i")).alias("row"), (F.col("p.col") + F.col("s.j")).alias("col"), F.col(f"p.{extent}").alias("hit"), ((F.col("s.i") == 0) & (F.col("s.j") == 0)).alias("self"))
    inside = spread.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    return inside.groupBy(image, "row", "col").agg(((F.max("hit") > 0) & (F.max(F.when(F.col("self"), F.col("hit"))) == 0)).cast("int").alias("boundary"))


#: Pixels of tiles that are worked on, and given on, together.
PIXELS = 1 << 18


def portions(b: pd.DataFrame, grown: int = 1) -> Iterator[pd.DataFrame]:
    """Rows with tiles (h, w) in portions of about PIXELS pixels, when each is enlarged grown times."""
    work = (b["h"].astype("int64") * b["w"] * grown).cumsum().to_numpy()
    part = (work - 1) // PIXELS if len(work) else work
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(b)]
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        yield b.iloc[i:j]


def on_tiles(tiles: DataFrame, keys: list[str], kernel: Callable[[np.ndarray], np.ndarray], out: str = "px") -> DataFrame:
    """Tiles (keys, h, w, px row by row) with px replaced by what the kernel makes of it; h and w follow."""
    kinds = dict(tiles.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "h int, w int", f"{out} array<double>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (p for whole in batches for p in portions(whole, 16)):
            made = [np.asarray(kernel(np.asarray(px, float).reshape(h, w)), float) for px, h, w in zip(b["px"], b["h"], b["w"], strict=True)]
            yield b[keys].assign(h=[m.shape[0] for m in made], w=[m.shape[1] for m in made], **{out: [m.ravel() for m in made]})

    return tiles.select(*keys, "h", "w", "px").mapInPandas(run, schema)


def distance_transform(tiles: DataFrame, keys: list[str]) -> DataFrame:
    return on_tiles(tiles, keys, kernels.distance)


def connected_components(tiles: DataFrame, keys: list[str], eight: bool = True) -> DataFrame:
    return on_tiles(tiles, keys, lambda x: kernels.label(x, eight))


def normalise_by_component(pixels: DataFrame, image: str, component: str, distance: str) -> DataFrame:
    """Distance divided by the component's greatest, as float; 0 outside."""
    most = F.max(distance).over(Window.partitionBy(image, component))
    return pixels.withColumn("normalised", F.when(F.col(component) > 0, F.col(distance) / most).otherwise(0.0).cast("float"))


def cloud_or_missing(cloudy: Column, valid: Column) -> Column:
    return cloudy | ~valid


def blocks(tiles: DataFrame, keys: list[str], size: int, halo: int) -> DataFrame:
    """Tiles cut into size x size blocks with a halo of neighbouring pixels: keys, block_row, block_col, top and left of
    the block with its halo, h, w, px. Each block is a row of its own, so a large raster is spread over tasks."""
    grid = lambda n: F.sequence(F.lit(0), F.floor((F.col(n) - 1) / size).cast("int"))
    cut = tiles.withColumn("block_row", F.explode(grid("h"))).withColumn("block_col", F.explode(grid("w")))
    low = lambda c: F.greatest(F.col(c) * size - halo, F.lit(0)).cast("int")
    high = lambda c, n: F.least((F.col(c) + 1) * size + halo, F.col(n)).cast("int")
    cut = cut.withColumns({"top": low("block_row"), "left": low("block_col"), "bottom": high("block_row", "h"), "right": high("block_col", "w")})
    lines = F.transform(F.sequence(F.col("top"), F.col("bottom") - 1), lambda r: F.slice("px", (r * F.col("w") + F.col("left") + 1).cast("int"), F.col("right") - F.col("left")))
    cut = cut.withColumn("_px", F.flatten(lines))  # before h and w are given anew, or the lambda would take the new ones
    return cut.select(*keys, "block_row", "block_col", "top", "left", (F.col("bottom") - F.col("top")).alias("h"), (F.col("right") - F.col("left")).alias("w"), F.col("_px").alias("px"))


def stacks(b: pa.RecordBatch, like: list[np.ndarray], column: str = "px") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their tiles as one array) for the rows of a batch (h, w) that are equal in like, about PIXELS at a time."""
    h, w = (b[c].to_numpy().astype(np.int64) for c in ("h", "w"))
    lists = b[column]
    start, flat = lists.offsets.to_numpy()[:-1], lists.values.to_numpy(zero_copy_only=False)
    kinds, kind = np.unique(np.stack([h, w, *like], axis=1), axis=0, return_inverse=True)
    for k, (height, width, *_) in enumerate(kinds):
        rows = np.flatnonzero(kind.ravel() == k)
        for some in np.split(rows, range(step := max(1, PIXELS // max(1, height * width)), len(rows), step)):
            yield some, flat[start[some][:, None] + np.arange(height * width)].reshape(len(some), height, width).astype(float)


def upsampled(tiles: DataFrame, keys: list[str], size: int, scale: int = 2, radius: int = 2) -> DataFrame:
    """Extents e and boundaries b of tiles (keys, h, w, e, b) combined, enlarged twice and smoothed, in blocks of size pixels:
    keys, top, left (in the enlarged tile), h, w, px from 0 to 1. Each block works on its own pixels and a halo; the least
    and the greatest value of a tile are found over all its blocks, in a pass of its own that gives on nothing else. The
    size changes nothing in the pixels. A tile with one value throughout has null pixels."""
    both = F.zip_with("e", "b", lambda e, b: F.greatest(F.lit(0.0), F.least(F.lit(2.0), 1 + e.cast("double") - b.cast("double"))))
    halo = kernels.upsample_reach(scale, radius)
    whole = tiles.select(*keys, "h", "w", both.alias("px"))
    square = scale * scale

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Rows and the pixels of their blocks, enlarged."""
        for whole_ in batches:
            pixels = whole_["h"].to_numpy().astype(np.int64) * whole_["w"].to_numpy() * square * square
            for cut in np.split(np.arange(whole_.num_rows), np.flatnonzero(np.diff(np.cumsum(pixels) // PIXELS)) + 1):
                b = whole_.slice(cut[0], len(cut)) if len(cut) else whole_
                begin = [b[c].to_numpy().astype(np.int64) * size - b[o].to_numpy() for c, o in (("block_row", "top"), ("block_col", "left"))]
                for rows, x in stacks(b, begin):
                    i, j = (int(v[rows[0]]) for v in begin)  # where the block begins in its halo
                    y = kernels.smooth_upsample(x, scale, radius, (i, j, size))
                    yield b.take(pa.array(rows)), y

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, y in made(batches):
            y = y.reshape(len(y), -1)
            yield pa.RecordBatch.from_arrays([*(b[k] for k in keys), pa.array(np.fmin.reduce(y, axis=1)), pa.array(y.max(axis=1))], [*keys, "low", "high"])

    def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, y in made(batches):
            n, h, w = y.shape
            low, high = (b[c].to_numpy()[:, None] for c in ("low", "high"))
            span = high - low
            with np.errstate(divide="ignore", invalid="ignore"):
                px = pa.array(((y.reshape(n, -1) - low) / span).ravel(), mask=np.repeat(span <= 1e-9, h * w))
            lists = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * h * w).astype(np.int32)), px)
            top, left = (pa.array((b[c].to_numpy() * size * square).astype(np.int32)) for c in ("block_row", "block_col"))
            yield pa.RecordBatch.from_arrays([*(b[k] for k in keys), top, left, *(pa.array(np.full(n, v, np.int32)) for v in (h, w)), lists], [*keys, "top", "left", "h", "w", "px"])

    kinds = dict(tiles.dtypes)
    named = ", ".join(f"{k} {kinds[k]}" for k in keys)
    n = 4 * tiles.sparkSession.sparkContext.defaultParallelism
    least = blocks(whole, keys, size, halo).mapInArrow(ends, f"{named}, low double, high double")
    least = least.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    known = whole.join(least, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*[f"_{k}" for k in keys]).repartition(n)
    return blocks(known, [*keys, "low", "high"], size, halo).mapInArrow(stretched, f"{named}, top int, left int, h int, w int, px array<double>")
