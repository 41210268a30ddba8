"""Writers: features, chunks, layers, metadata, status."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_features(rasters: DataFrame, path: str) -> None:
    """Write rasters by feature; only the features in rasters replace what is there."""
    rasters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feature").parquet(path)


def save_chunks(rows: DataFrame, path: str, by: tuple[str, ...] = ("chunk",)) -> None:
    """Write rows in a folder for each chunk (or fold and chunk), each from one task."""
    rows.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def save_metadata(rows: DataFrame, path: str) -> None:
    """Write metadata as CSV with a header. path is another one than what rows are read from."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def save_layer(layer: DataFrame, path: str, *by: str) -> None:
    """Write polygons with their box columns, so that readers can skip what lies elsewhere."""
    layer.write.mode("overwrite").partitionBy(*by).parquet(path)


def save_merged(rasters: DataFrame, path: str) -> None:
    """Write merged rasters in a folder for each interval and reference system."""
    rasters.write.mode("overwrite").partitionBy("interval", "epsg").parquet(path)


def with_status(items: DataFrame, key: str, work) -> DataFrame:
    """name, status, error: what came of work(row) for each item; a failure is a row, not the end of the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                try:
                    work(row)
                    out.append((str(row[key]), "Success", None))
                except Exception as e:  # noqa: BLE001
                    out.append((str(row[key]), "Failure", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["name", "status", "error"])

    return items.mapInPandas(run, "name string, status string, error string")


def failures(status: DataFrame) -> DataFrame:
    return status.where(F.col("status") != "Success")
