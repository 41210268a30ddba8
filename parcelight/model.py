"""Settings of the stages: what each of them reads, and nothing about where data lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class IngestConfig:
    band_names: tuple[str, ...] = ("B02", "B03", "B04", "B08")
    mask_name: str = "dataMask"
    data_name: str = "BANDS"
    is_data_mask: str = "IS_DATA"
    clp_name: str = "CLP"
    clm_name: str = "CLM"
    average_over: int = 24
    max_clp: float = 255.0
    cloud_threshold: float = 0.4
    cloud_dilation: int = 11


@dataclass(frozen=True)
class RasteriseConfig:
    extent_feature: str = "EXTENT"
    boundary_feature: str = "BOUNDARY"
    distance_feature: str = "DISTANCE"
    buffer_poly: float = -10.0
    width: int = 1100
    height: int = 1100
    disk_radius: int = 2


@dataclass(frozen=True)
class SamplingConfig:
    sample_positive: bool = True
    mask_feature_name: str = "EXTENT"
    buffer: int = 50
    patch_size: int = 256
    num_samples: int = 10
    fraction_valid: float = 0.2
    seed: int = 0


@dataclass(frozen=True)
class SplitConfig:
    n_folds: int = 3
    seed: int = 2


@dataclass(frozen=True)
class PredictionConfig:
    pad_buffer: int = 14
    crop_buffer: int = 26


@dataclass(frozen=True)
class PostProcessConfig:
    feature_extent: str = "EXTENT_PREDICTED"
    feature_boundary: str = "BOUNDARY_PREDICTED"
    max_cloud_coverage: float = 0.05
    valid_data_fraction: float = 1.0
    percentile: float = 50.0
    scale_factor: int = 2
    disk_size: int = 2
    masked_temporal_merging: bool = False
    disk_size_masking: int = 5
    block: int | None = None


@dataclass(frozen=True)
class VectorisationConfig:
    shape: tuple[int, int] = (4400, 4400)
    buffer: tuple[int, int] = (200, 200)
    chunk_size: int = 500
    threshold: float = 0.6


@dataclass(frozen=True)
class MergeConfig:
    resulting_crs: int = 32634
    max_area: float | None = None
    simplify_tolerance: float | None = 2.5
    cell: float = 1000.0
    together: bool = False
