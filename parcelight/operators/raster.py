"""Pixel-form raster operators: a row for each pixel (image, row, col), everything in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import hashed


def combine_extent_boundary(extent: Column, boundary: Column) -> Column:
    """1 + extent - boundary, kept within 0 and 2."""
    return F.greatest(F.least(1 + extent - boundary, F.lit(2.0)), F.lit(0.0))


def rescale(pixels: DataFrame, image: str, value: str, out: str = "scaled") -> DataFrame:
    """Values stretched to [0, 1] over each image; null where an image has only one value."""
    w = Window.partitionBy(image)
    low, high = F.min(value).over(w), F.max(value).over(w)
    return pixels.withColumn(out, (F.col(value) - low) / F.nullif(high - low, F.lit(0.0)))


def pad_edge(pixels: DataFrame, image: str, height: int, width: int, buffer: int) -> DataFrame:
    """Images grown by buffer on each side, edge pixels repeated.

    Every pixel is copied to where it belongs: inner ones once, edges buffer + 1 times, so nothing is joined.
    """
    places = lambda c, n: F.when(F.col(c) == 0, F.sequence(F.lit(0), F.lit(buffer) + F.when(F.lit(n) == 1, buffer).otherwise(0))).when(F.col(c) == n - 1, F.sequence(F.lit(n - 1 + buffer), F.lit(n - 1 + 2 * buffer))).otherwise(F.array(F.col(c) + buffer))
    return pixels.withColumn("row", F.explode(places("row", height))).withColumn("col", F.explode(places("col", width)))


def crop(pixels: DataFrame, height: int, width: int, buffer: int) -> DataFrame:
    """Images less buffer on each side."""
    inside = F.col("row").between(buffer, height - buffer - 1) & F.col("col").between(buffer, width - buffer - 1)
    return pixels.where(inside).withColumns({"row": F.col("row") - buffer, "col": F.col("col") - buffer})


def flip_left_right(pixels: DataFrame, width: int) -> DataFrame:
    return pixels.withColumn("col", F.lit(width - 1) - F.col("col"))


def flip_up_down(pixels: DataFrame, height: int) -> DataFrame:
    return pixels.withColumn("row", F.lit(height - 1) - F.col("row"))


def rot90(pixels: DataFrame, side: int, k: int | Column = 1) -> DataFrame:
    """Square images turned counter-clockwise by k quarter turns."""
    k = (F.lit(k) if isinstance(k, int) else k) % 4
    r, c, last = F.col("row"), F.col("col"), F.lit(side - 1)
    return pixels.withColumns({"row": F.when(k == 1, last - c).when(k == 2, last - r).when(k == 3, c).otherwise(r), "col": F.when(k == 1, r).when(k == 2, last - c).when(k == 3, last - r).otherwise(c)})


def brightness(value: Column, delta: Column | float) -> Column:
    return value + delta


def contrast(pixels: DataFrame, image: str, value: str, factor: Column | float, out: str = "contrasted") -> DataFrame:
    """Distance from the image's mean, times factor."""
    mean = F.avg(value).over(Window.partitionBy(image))
    return pixels.withColumn(out, (F.col(value) - mean) * factor + mean)


def draw(key: Column, name: str, seed: int = 0) -> Column:
    """A number in [0, 1) for each sample and purpose, the same on every run."""
    return hashed(key, F.lit(name), F.lit(seed)) / F.lit(float(1 << 32))


def augment(pixels: DataFrame, image: str, features: list[str], side: int, delta: float = 0.1, bounds: tuple[float, float] = (0.9, 1.1), seed: int = 0) -> DataFrame:
    """Flips and turns drawn once for each image, so features and labels move together; brightness and contrast change
    the features alone."""
    key = F.col(image)
    lr, ud = draw(key, "lr", seed) < 0.5, draw(key, "ud", seed) < 0.5
    out = pixels.withColumn("col", F.when(lr, F.lit(side - 1) - F.col("col")).otherwise(F.col("col")))
    out = out.withColumn("row", F.when(ud, F.lit(side - 1) - F.col("row")).otherwise(F.col("row")))
    out = rot90(out, side, F.floor(draw(key, "turn", seed) * 4).cast("int"))
    shift, factor = (draw(key, "light", seed) * 2 - 1) * delta, draw(key, "contrast", seed) * (bounds[1] - bounds[0]) + bounds[0]
    for f in features:
        out = contrast(out.withColumn(f, F.col(f) + shift), image, f, factor, f)
    return out


def one_minus(p: Column) -> Column:
    """(1 - p, p)."""
    return F.array(1 - p, p)


def one_hot(value: Column, depth: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), lambda i: F.when(i == value, 1).otherwise(0))


def fill_nan(value: Column, fill: float = -2.0) -> Column:
    return F.nanvl(value, F.lit(fill))


def replace_value(value: Column, old: float = 65535, new: float = -1) -> Column:
    return F.when(value == old, F.lit(new)).otherwise(value)


def to_float(value: Column) -> Column:
    return value.cast("float")


def normalize(value: Column, scaler: float, mean: float | None = None) -> Column:
    return (value - mean if mean is not None else value) / scaler


def labels_struct(names: list[str], *values: Column) -> Column:
    """Labels by name; as many values as names."""
    if len(names) != len(values):
        raise ValueError(f"{len(names)} names for {len(values)} labels")
    return F.struct(*[v.alias(n) for n, v in zip(names, values, strict=True)])


def argmax(values: Column) -> Column:
    return F.array_position(values, F.array_max(values)) - 1


def positive_class(probabilities: Column) -> Column:
    """The second channel of a prediction."""
    return F.element_at(probabilities, 2)


def true_colour(value: Column, factor: float) -> Column:
    return F.greatest(F.least(value * factor, F.lit(1.0)), F.lit(0.0))


def stack_bands(*bands: Column) -> Column:
    return F.array(*bands)


def over_time(scenes: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Timeless labels repeated for each scene of their patchlet."""
    return scenes.join(labels, key)


def to_tiles(pixels: DataFrame, keys: list[str], value: str, height: int, width: int) -> DataFrame:
    """Tile form: one row for each image with its pixels row by row."""
    cells = F.sort_array(F.collect_list(F.struct("row", "col", value)))
    return pixels.groupBy(*keys).agg(F.transform(cells, lambda s: s[value]).alias("px")).withColumns({"h": F.lit(height), "w": F.lit(width)})


def to_pixels(tiles: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """Pixel form of tiles with px, h, w."""
    return tiles.select(*keys, "w", F.posexplode("px").alias("pos", value)).select(*keys, F.floor(F.col("pos") / F.col("w")).cast("int").alias("row"), (F.col("pos") % F.col("w")).cast("int").alias("col"), value)
