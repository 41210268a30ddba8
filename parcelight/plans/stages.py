"""The stages of parcel delineation as functions from DataFrames to DataFrames.

Tables: rasters (tile, feature, t_idx, ts, h, w, px row by row), parcels (id, rings, x0, y0, x1, y1), metadata. A stage
reads what it needs and returns what it makes; writing is left to sources.sinks. Tiles stay whole rows, which Spark
spreads over tasks; only statistics and sampled windows are exploded to pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..model import IngestConfig, MergeConfig, PostProcessConfig, PredictionConfig, RasteriseConfig, SamplingConfig, SplitConfig, VectorisationConfig
from ..operators import focal, mosaic, raster, sampling, scenes, spatial, stats, vectorise, zones


def ingest(bands: DataFrame, dates: DataFrame, config: IngestConfig) -> DataFrame:
    """Rasters of bands, mask and clouds, from bands (tile, name, t_idx, h, w, px) and dates (tile, dates)."""
    timed = scenes.with_timestamps(bands, dates)
    named = F.when(F.col("name") == config.mask_name, config.is_data_mask).when(F.col("name") == config.clp_name, config.clp_name).otherwise(F.concat(F.lit(f"{config.data_name}_"), F.col("name")))
    out = timed.where(F.col("name").isin(*config.band_names, config.mask_name, config.clp_name)).withColumn("feature", named)
    out = out.select("tile", "feature", "t_idx", "ts", "h", "w", F.transform("px", lambda v: v.cast("double")).alias("px"))
    keys = ["tile", "t_idx", "ts"]
    mask = lambda x: kernels.cloud_mask(x / config.max_clp, config.average_over, config.cloud_threshold, config.cloud_dilation)
    clouds = focal.on_tiles(out.where(F.col("feature") == config.clp_name), keys, mask)
    return out.unionByName(clouds.withColumn("feature", F.lit(config.clm_name)))


def rasterise(grid: DataFrame, parcels: DataFrame, config: RasteriseConfig, cell: float = 11_000.0, resolution: float = 10.0) -> DataFrame:
    """Extent, boundary and distance of each tile of grid (tile, x0, y0, x1, y1) from the parcels that meet it."""
    pairs = spatial.box_join(grid, parcels, cell).select(F.col("l.tile").alias("tile"), F.col("l.x0").alias("x0"), F.col("l.y1").alias("y1"), F.col("r.rings").alias("rings"))
    shapes = grid.select("tile", F.col("x0").alias("gx"), F.col("y1").alias("gy")).join(pairs.groupBy("tile").agg(F.collect_list("rings").alias("shapes")), "tile", "left")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = []
            for row in b.to_pylist():
                polygons = [[[((p["x"] - row["gx"]) / resolution, (row["gy"] - p["y"]) / resolution) for p in ring] for ring in g] for g in row["shapes"] or []]
                extent = kernels.rasterise(polygons, config.height, config.width, max(0.0, -config.buffer_poly) / resolution)
                edge = kernels.boundary(extent, config.disk_radius)
                far = kernels.normalised_distance(extent) if not extent.all() else np.ones(extent.shape, np.float32)
                out += [(row["tile"], f, config.height, config.width, x.astype(float).ravel()) for f, x in ((config.extent_feature, extent), (config.boundary_feature, edge), (config.distance_feature, far))]
            t, f, h, w, px = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(t, b.schema.field("tile").type), pa.array(f, pa.string()), pa.array(h, pa.int32()), pa.array(w, pa.int32()), pa.array(list(px), pa.list_(pa.float64()))], ["tile", "feature", "h", "w", "px"])

    return shapes.mapInArrow(run, f"tile {dict(grid.dtypes)['tile']}, feature string, h int, w int, px array<double>")


def sample(labels: DataFrame, config: SamplingConfig) -> DataFrame:
    """Patchlet windows of each tile, from rasters of the mask feature."""
    pixels = raster.to_pixels(labels.where(F.col("feature") == config.mask_feature_name), ["tile", "h", "w"], "mask")
    ratios = sampling.window_ratios(pixels, "tile", F.col("mask") != 0, config.patch_size)
    sizes = labels.where(F.col("feature") == config.mask_feature_name).select("tile", "h", "w")
    low, high = config.buffer, lambda n: F.col(n) - config.patch_size - config.buffer
    inside = ratios.join(sizes, "tile").where((F.col("row") >= low) & (F.col("row") < high("h")) & (F.col("col") >= low) & (F.col("col") < high("w")))
    return sampling.sample_windows(inside, "tile", config.num_samples, config.fraction_valid, config.sample_positive, config.seed)


def normalise(pixels: DataFrame, metadata: DataFrame, bands: list[str]) -> DataFrame:
    """Metadata with statistics and monthly factors, from pixels (patchlet, timestamp, bands)."""
    made = stats.band_stats(pixels, ["patchlet", "timestamp"], bands, ("mean", "median", "perc_99", "std"))
    return stats.with_factors(metadata, made, stats.monthly_factors(made, "timestamp", len(bands)), ["patchlet", "timestamp"], "timestamp")


def split(metadata: DataFrame, config: SplitConfig) -> DataFrame:
    """Metadata with a fold for each tile."""
    return metadata.withColumn("fold", sampling.fold(F.col("eopatch"), config.n_folds, config.seed))


def predict(rasters: DataFrame, model: Callable[[np.ndarray], dict[str, np.ndarray]], config: PredictionConfig) -> DataFrame:
    """What the model makes of each scene, from scenes (tile, t_idx, ts, h, w, bands: array of arrays, mean, std: arrays).

    model gets an array (h, w, bands), normalised and padded, and returns an array for each output feature; those are
    cropped and become rasters of that feature. The model object travels to the tasks.
    """
    schema = "tile string, t_idx int, ts timestamp_ntz, feature string, h int, w int, px array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                x = np.stack([np.asarray(v, float).reshape(row.h, row.w) for v in row.bands], axis=-1)
                x = (x - np.asarray(row.mean, float)) / np.asarray(row.std, float)
                p, c = config.pad_buffer, config.crop_buffer
                x = np.pad(x, ((p, p), (p, p), (0, 0)), mode="edge")
                for feature, y in model(x).items():
                    y = y[c : y.shape[0] - c, c : y.shape[1] - c] if c else y
                    out.append((row.tile, row.t_idx, row.ts, feature, *y.shape, y.astype(float).ravel()))
            yield pd.DataFrame(out, columns=["tile", "t_idx", "ts", "feature", "h", "w", "px"])

    return rasters.select("tile", "t_idx", "ts", "h", "w", "bands", "mean", "std").mapInPandas(run, schema)


def merge_time(rasters: DataFrame, masks: DataFrame, interval: tuple[str, str], config: PostProcessConfig) -> DataFrame:
    """One raster for each tile and feature of an interval: the percentile of its scenes, per pixel.

    masks: tile, t_idx, cloudy and valid (arrays). By default scenes over the cloud limit, or not wholly valid, are left
    out whole; with masked merging their cloudy (dilated) and missing pixels are.
    """
    inside = rasters.where(scenes.in_interval(F.col("ts"), *interval)).join(masks, ["tile", "t_idx"])
    masked = config.masked_temporal_merging

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, w = int(pdf["h"].iloc[0]), int(pdf["w"].iloc[0])
        layers = []
        for row in pdf.sort_values("t_idx").itertuples(index=False):
            x = np.array(row.px, float).reshape(h, w)
            cloudy, valid = (np.asarray(v, bool).reshape(h, w) for v in (row.cloudy, row.valid))
            if masked:
                x[(kernels.disk_max((cloudy | ~valid).astype(float), config.disk_size_masking) > 0)] = np.nan
            elif not (cloudy.mean() < config.max_cloud_coverage and valid.mean() == config.valid_data_fraction):
                continue
            layers.append(x)
        if not layers:
            return pd.DataFrame({"tile": [], "feature": [], "h": [], "w": [], "px": []})
        x = np.stack(layers)
        empty = np.isnan(x).all(axis=0)
        x[:, empty] = 0.0
        return pd.DataFrame({"tile": [pdf["tile"].iloc[0]], "feature": [pdf["feature"].iloc[0]], "h": [h], "w": [w], "px": [np.nanpercentile(x, config.percentile, axis=0).ravel()]})

    return inside.groupBy("tile", "feature").applyInPandas(run, "tile string, feature string, h int, w int, px array<double>")


def combine(merged: DataFrame, config: PostProcessConfig) -> DataFrame:
    """Extent and boundary of each tile combined, enlarged and smoothed: tile, h, w, px. With config.block, in blocks of so
    many pixels (tile, top, left, h, w, px), for tiles that are large for a task."""
    side = lambda f, n: merged.where(F.col("feature") == f).select("tile", "h", "w", F.col("px").alias(n))
    both = side(config.feature_extent, "e").join(side(config.feature_boundary, "b").drop("h", "w"), "tile")
    if config.block is not None:
        return focal.upsampled(both, ["tile"], config.block, config.scale_factor, config.disk_size)
    packed = both.select("tile", (F.col("h") * 2).alias("h"), "w", F.concat("e", "b").alias("px"))
    make = lambda x: kernels.combine_upsample(x[: len(x) // 2], x[len(x) // 2 :], config.scale_factor, config.disk_size)
    return focal.on_tiles(packed, ["tile"], make)


def vectors(tiles: DataFrame, config: VectorisationConfig) -> DataFrame:
    """Polygons of each zone, from tiles (zone, g_row, g_col of the corner, h, w, px): weighted overlaps, blocks, tracing."""
    pixels = raster.to_pixels(tiles.select("zone", "g_row", "g_col", "h", "w", "px"), ["zone", "g_row", "g_col"])
    weight = mosaic.edge_weight(F.col("row"), F.col("col"), *config.shape, config.buffer)
    placed = pixels.select("zone", (F.col("g_row") + F.col("row")).alias("row"), (F.col("g_col") + F.col("col")).alias("col"), "v", weight.alias("weight"))
    merged = mosaic.overlap_average(placed, ["zone", "row", "col"], "v", "weight")
    size = config.chunk_size
    # a pixel belongs to its block, and to its neighbours where it lies at a border: at most to four
    near = lambda c: F.array_distinct(F.array(*[F.floor((F.col(c) + i) / size).cast("int") for i in (-1, 0, 1)]))
    block = merged.withColumn("block_row", F.explode(near("row"))).withColumn("block_col", F.explode(near("col")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        top, left = int(pdf["row"].min()), int(pdf["col"].min())
        x = np.full((int(pdf["row"].max()) - top + 1, int(pdf["col"].max()) - left + 1), config.threshold - 1.0)
        x[pdf["row"] - top, pdf["col"] - left] = pdf["value"]
        first = pdf.iloc[0]
        return pd.DataFrame({"zone": [first["zone"]], "block_row": [int(first["block_row"])], "block_col": [int(first["block_col"])], "top": [top], "left": [left], "h": [x.shape[0]], "w": [x.shape[1]], "px": [x.ravel()]})

    kinds = dict(tiles.dtypes)
    blocks = block.groupBy("zone", "block_row", "block_col").applyInPandas(run, f"zone {kinds['zone']}, block_row int, block_col int, top int, left int, h int, w int, px array<double>")
    return vectorise.parcels(blocks, "zone", config.threshold, size)


def merge(left: DataFrame, right: DataFrame, epsg: tuple[int, int], overlap: DataFrame | None, config: MergeConfig) -> DataFrame:
    """Two zones' polygons as one layer: source, area, rings."""
    return zones.merged(left, right, epsg, config.resulting_crs, config.cell, overlap, config.max_area, config.simplify_tolerance, config.together)
