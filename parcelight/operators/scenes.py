"""Cloud and validity predicates on scenes, and merging of predictions over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cloud_probability(clp: Column, most: float = 255.0) -> Column:
    """Cloud probability in [0, 1] from its 8-bit form."""
    return clp / F.lit(most)


def with_timestamps(rasters: DataFrame, dates: DataFrame) -> DataFrame:
    """Rasters (tile, t_idx) with the tile's dates (an array of timestamps) attached by position."""
    return rasters.join(dates.select("tile", F.posexplode("dates").alias("t_idx", "ts")), ["tile", "t_idx"])


def clear_scenes(pixels: DataFrame, keys: list[str], cloud_coverage: float, patch_size: int | None = None) -> DataFrame:
    """Images under the cloud limit without an invalid pixel.

    The cloud share is that of all pixels; with patch_size it is cloudy pixels divided by the side length only, a
    stricter limit that some data was made with.
    """
    n = F.count(F.lit(1)) if patch_size is None else F.lit(patch_size)
    counted = pixels.groupBy(*keys).agg(F.count_if("cloudy").alias("cloudy_px"), F.count_if(~F.col("valid")).alias("invalid_px"), (F.count_if("cloudy") / n).alias("ratio"))
    return counted.where((F.col("ratio") < cloud_coverage) & (F.col("invalid_px") == 0))


def scene_fractions(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Share of cloudy and of valid pixels of each scene."""
    return pixels.groupBy(*keys).agg(F.avg(F.col("cloudy").cast("double")).alias("cloud_fraction"), F.avg(F.col("valid").cast("double")).alias("valid_fraction"))


def in_interval(ts: Column, start: str, end: str) -> Column:
    """start <= date < end."""
    day = F.to_date(ts)
    return (day >= F.to_date(F.lit(start))) & (day < F.to_date(F.lit(end)))


def usable_scenes(fractions: DataFrame, start: str, end: str, max_cloud: float, valid: float = 1.0, ts: str = "ts") -> DataFrame:
    """Scenes of the interval under the cloud limit with exactly this share of valid pixels."""
    return fractions.where(in_interval(F.col(ts), start, end) & (F.col("cloud_fraction") < max_cloud) & (F.col("valid_fraction") == valid))


def number(c: str) -> Column:
    """A value, or null for NaN: percentiles skip nulls but would rank NaN."""
    return F.when(~F.isnan(c), F.col(c))


def temporal_percentile(pixels: DataFrame, keys: list[str], value: str, percentile: float = 50.0) -> DataFrame:
    """The percentile over time of each pixel's values; 0 where there is none."""
    return pixels.groupBy(*keys).agg(F.coalesce(F.percentile(number(value), F.lit(percentile / 100)), F.lit(0.0)).alias("merged"), F.count(number(value)).alias("n"))


def masked_temporal_percentile(pixels: DataFrame, keys: list[str], value: str, percentile: float = 50.0) -> DataFrame:
    """As temporal_percentile, with cloudy or invalid observations left out. A pixel masked throughout gets 0."""
    masked = F.when(~F.col("cloudy") & F.col("valid"), number(value))
    return pixels.groupBy(*keys).agg(F.coalesce(F.percentile(masked, F.lit(percentile / 100)), F.lit(0.0)).alias("merged"), F.count(masked).alias("n"))
