"""Readers: vector layers, tile dates, chunks, metadata, rasters."""

from __future__ import annotations

import sqlite3
import struct
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import areas, spatial

RINGS = T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
METADATA = "chunk string, eopatch string, patchlet string, chunk_pos int, timestamp timestamp_ntz"


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """part, rings, properties (JSON) of a feature collection in WGS 84: one row for each polygon of each feature."""
    coordinates = "array<array<array<array<double>>>>"
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.get_json_object("value", "$.crs.properties.name").alias("crs"), F.explode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("f"))
    wgs = F.coalesce(F.col("crs"), F.lit("urn:ogc:def:crs:OGC:1.3:CRS84")).rlike("CRS84|4326")
    checked = parsed.withColumn("f", F.when(wgs, F.col("f")).otherwise(F.raise_error("a layer in WGS 84 is needed")))
    kind, where = F.get_json_object("f", "$.geometry.type"), F.get_json_object("f", "$.geometry.coordinates")
    multi = F.when(kind == "Polygon", F.concat(F.lit("["), where, F.lit("]"))).otherwise(where)
    rings = lambda g: F.transform(g, lambda r: F.transform(F.slice(r, 1, F.size(r) - 1), lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return checked.select(F.get_json_object("f", "$.properties").alias("properties"), F.posexplode(F.from_json(multi, coordinates)).alias("part", "g")).select("part", rings(F.col("g")).alias("rings"), "properties")


def userdata_dates(raw: DataFrame, column: str) -> DataFrame:
    """raw with dates: the timestamps of a JSON array which is itself a string in a JSON object."""
    inner = F.from_json(F.from_json(column, "dates string")["dates"], "array<string>")
    return raw.withColumn("dates", F.transform(inner, lambda d: F.to_timestamp_ntz(F.regexp_replace(d, "(Z|[+-][0-9]{2}:?[0-9]{2})$", ""))))


def userdata(spark: SparkSession, folder: str) -> DataFrame:
    """tile, dates of every userdata.json below a folder."""
    raw = spark.read.text(f"{folder}/*/userdata.json", wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("tile"), "value")
    return userdata_dates(raw, "value").select("tile", "dates")


def metadata(spark: SparkSession, path: str, schema: str = METADATA) -> DataFrame:
    """Metadata CSV with an explicit schema; a time zone in timestamps is dropped."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    kinds = [c.strip().split()[1] for c in schema.split(",")]
    raw = spark.read.csv(path, header=True, schema=", ".join(f"{n} {'string' if k == 'timestamp_ntz' else k}" for n, k in zip(names, kinds, strict=True)))
    return raw.select(*[F.to_timestamp_ntz(F.regexp_replace(n, "(Z|[+-][0-9]{2}:?[0-9]{2})$", "")).alias(n) if k == "timestamp_ntz" else F.col(n) for n, k in zip(names, kinds, strict=True)])


def npz(spark: SparkSession, path: str, feature: str) -> DataFrame:
    """file, pos, shape, values (row by row) of one array of each chunk file: an entry of the first axis is a row."""
    import io

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, raw in zip(b["path"], b["content"], strict=True):
                x = np.load(io.BytesIO(raw))[feature]
                yield pd.DataFrame({"file": name, "pos": np.arange(len(x), dtype=np.int32), "shape": [list(x.shape[1:])] * len(x), "values": [e.astype(float).ravel() for e in x]})

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    return files.mapInPandas(run, "file string, pos int, shape array<int>, values array<double>")


def files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """path, name, size of the files below a folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    return listed.where(F.col("name").endswith(suffix)) if suffix else listed


def wkb_rings(raw: bytes) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a WKB polygon or multipolygon."""

    def one(at: int) -> tuple[list, int]:
        order = "<" if raw[at] else ">"
        kind, n = struct.unpack_from(order + "II", raw, at + 1)
        at += 9
        if kind % 1000 == 6:
            out = []
            for _ in range(n):
                some, at = one(at)
                out += some
            return out, at
        rings = []
        for _ in range(n):
            (k,) = struct.unpack_from(order + "I", raw, at)
            values = struct.unpack_from(f"{order}{2 * k}d", raw, at + 4)
            rings.append(list(zip(values[:-2:2], values[1:-2:2], strict=True)))
            at += 4 + 16 * k
        return [rings], at

    return one(0)[0]


def geopackage(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """file, fid, part, rings of a layer in each GeoPackage at path; a file is read by one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, raw in zip(b["path"], b["content"], strict=True):
                with tempfile.TemporaryDirectory() as folder:  # the file format needs a local copy while it is read
                    (Path(folder) / "x.gpkg").write_bytes(raw)
                    with sqlite3.connect(Path(folder) / "x.gpkg") as db:
                        (column,) = db.execute("select column_name from gpkg_geometry_columns where table_name = ?", (layer,)).fetchone()
                        rows = db.execute(f'select rowid, "{column}" from "{layer}"').fetchall()
                out = []
                for fid, blob in rows:
                    head = 8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[blob[3] >> 1 & 7]
                    out += [(name, fid, k, [[{"x": x, "y": y} for x, y in ring] for ring in g]) for k, g in enumerate(wkb_rings(blob[head:]))]
                yield pd.DataFrame(out, columns=["file", "fid", "part", "rings"])

    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("fid", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("rings", RINGS)])
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content").mapInPandas(run, schema)


def cubes(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """Rasters of the named features; others are not read, as features are partitions."""
    return spark.read.parquet(path).where(F.col("feature").isin(features))


def parcels_in(parcels: DataFrame, box: tuple[float, float, float, float], exact: bool = False, key: str = "id") -> DataFrame:
    """Parcels whose box shares a point with the given one: plain comparisons, which reach the scan or the database. exact:
    of these, the ones whose shape (rings) does."""
    x0, y0, x1, y1 = (float(v) for v in box)
    found = parcels.where((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))
    if not exact:
        return found
    corners = [F.lit(v).alias(c) for v, c in zip((x0, y0, x1, y1), spatial.BOX, strict=True)]
    area = parcels.sparkSession.range(1).select(*corners, spatial.rectangle_rings(*corners).alias("rings"))
    return areas.split_by_area(found, area, max(x1 - x0, y1 - y0), key)[1]


def pixel_samples(scenes: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """One row for each pixel with an array per band, in the order of acquisition."""
    samples = F.sort_array(F.collect_list(F.struct("ts", *bands)))
    return scenes.groupBy(*keys).agg(samples.alias("s")).select(*keys, F.transform("s", lambda s: s["ts"]).alias("dates"), *[F.transform("s", lambda s, b=b: s[b]).alias(b) for b in bands])


def scene_catalog(scenes: DataFrame, start: str, end: str, max_cloud: float, order: str = "cloud") -> DataFrame:
    """Scenes of a time interval up to a cloud share, least cloudy or most recent first."""
    day = F.to_date("ts")
    by: Column = F.col("cloud") if order == "cloud" else F.col("ts").desc()
    return scenes.where((day >= F.to_date(F.lit(start))) & (day <= F.to_date(F.lit(end))) & (F.col("cloud") <= max_cloud)).orderBy(by)
