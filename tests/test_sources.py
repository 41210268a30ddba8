"""Readers, writers, stages and the stream on small files."""

import datetime as dt
import json
import sqlite3
import struct

import numpy as np
from pyspark.sql import functions as F

from parcelight.model import PostProcessConfig, PredictionConfig, RasteriseConfig, SamplingConfig, VectorisationConfig
from parcelight.operators import dissolve, raster
from parcelight.plans import stages
from parcelight.sources import readers, sinks
from parcelight.streaming import ingest


def test_geojson(spark, tmp_path):
    ring = [[0, 0], [2, 0], [2, 2], [0, 0]]
    f = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(f))
    rows = readers.geojson(spark, str(tmp_path / "a.geojson")).collect()
    assert [len(r["rings"][0]) for r in rows] == [3, 3]


def test_userdata(spark, tmp_path):
    (tmp_path / "T1").mkdir()
    (tmp_path / "T1" / "userdata.json").write_text(json.dumps({"dates": json.dumps(["2020-04-01T09:40:01Z", "2020-04-03T09:40:01+00:00"])}))
    (row,) = readers.userdata(spark, str(tmp_path)).collect()
    assert row["tile"] == "T1" and row["dates"] == [dt.datetime(2020, 4, 1, 9, 40, 1), dt.datetime(2020, 4, 3, 9, 40, 1)]


def test_npz_and_files(spark, tmp_path):
    np.savez(tmp_path / "c0.npz", X=np.arange(24).reshape(2, 3, 4))
    rows = readers.npz(spark, str(tmp_path / "*.npz"), "X").orderBy("pos").collect()
    assert rows[1]["values"] == list(map(float, range(12, 24))) and rows[0]["shape"] == [3, 4]
    assert [r["name"] for r in readers.files(spark, str(tmp_path), ".npz").collect()] == ["c0.npz"]


def test_geopackage(spark, tmp_path):
    path = tmp_path / "g.gpkg"
    ring = [0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 0.0]
    blob = b"GP\0\1" + struct.pack("<i", 4326) + struct.pack("<BII", 1, 3, 1) + struct.pack("<I8d", 4, *ring)
    with sqlite3.connect(path) as db:
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
        db.execute("insert into gpkg_geometry_columns values ('grid', 'geom')")
        db.execute("create table grid (fid integer primary key, geom blob)")
        db.execute("insert into grid (geom) values (?)", (blob,))
    (row,) = readers.geopackage(spark, str(path), "grid").collect()
    assert [(p["x"], p["y"]) for p in row["rings"][0]] == [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)]


def test_features_overwritten_alone(spark, tmp_path):
    path = str(tmp_path / "cube")
    sinks.save_features(spark.createDataFrame([("a", "X", 1), ("a", "Y", 2)], "tile string, feature string, v int"), path)
    sinks.save_features(spark.createDataFrame([("a", "Y", 3)], "tile string, feature string, v int"), path)
    assert {(r["feature"], r["v"]) for r in spark.read.parquet(path).collect()} == {("X", 1), ("Y", 3)}
    assert readers.cubes(spark, path, ["Y"]).count() == 1


def test_status_rows(spark):
    def work(row):
        if row["n"] == 2:
            raise ValueError("two")

    rows = sinks.with_status(spark.createDataFrame([(1,), (2,)], "n int"), "n", work).collect()
    assert {(r["name"], r["status"]) for r in rows} == {("1", "Success"), ("2", "Failure")}


def test_crop_undoes_pad(spark):
    x = spark.createDataFrame([(0, r, c, float(r * 3 + c)) for r in range(2) for c in range(3)], "img int, row int, col int, v double")
    back = raster.crop(raster.pad_edge(x, "img", 2, 3, 2), 6, 7, 2)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, x.collect()))


def test_components_of_a_long_path(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    out = dissolve.connected(spark.range(n + 3), edges).collect()
    assert {r["component"] for r in out if r["id"] <= n} == {0} and {r["component"] for r in out if r["id"] > n} == {n + 1, n + 2}


def test_rasterise_and_sample(spark):
    grid = spark.createDataFrame([("t", 0.0, 0.0, 160.0, 160.0)], "tile string, x0 double, y0 double, x1 double, y1 double")
    ring = [{"x": x, "y": y} for x, y in ((20.0, 20.0), (140.0, 20.0), (140.0, 140.0), (20.0, 140.0))]
    parcels = spark.createDataFrame([(1, [ring], 20.0, 20.0, 140.0, 140.0)], "id int, rings array<array<struct<x: double, y: double>>>, x0 double, y0 double, x1 double, y1 double")
    labels = stages.rasterise(grid, parcels, RasteriseConfig(buffer_poly=-10.0, width=16, height=16), 160.0).cache()
    extent = np.array(labels.where("feature = 'EXTENT'").first()["px"]).reshape(16, 16)
    assert extent.sum() == 100 and extent[8, 8] == 1
    picked = stages.sample(labels, SamplingConfig(buffer=2, patch_size=4, num_samples=3, fraction_valid=0.5)).collect()
    assert len(picked) == 3 and all(r["ratio"] >= 0.5 and 2 <= r["row"] < 10 for r in picked)


def test_predict_merge_combine(spark):
    ts = [dt.datetime(2020, 4, d) for d in (1, 2, 3)]
    scenes = spark.createDataFrame([("t", k, d, 4, 4, [[float(k)] * 16, [1.0] * 16], [0.0, 0.0], [1.0, 1.0]) for k, d in enumerate(ts)], "tile string, t_idx int, ts timestamp_ntz, h int, w int, bands array<array<double>>, mean array<double>, std array<double>")

    def model(x):
        ramp = np.add.outer(np.arange(x.shape[0]), np.arange(x.shape[1])) / 10.0
        return {"EXTENT_PREDICTED": x[..., 0] + ramp, "BOUNDARY_PREDICTED": ramp[::-1] * 0.5}

    made = stages.predict(scenes, model, PredictionConfig(pad_buffer=1, crop_buffer=1))
    masks = spark.createDataFrame([("t", k, [k == 2] * 16, [True] * 16) for k in range(3)], "tile string, t_idx int, cloudy array<boolean>, valid array<boolean>")
    config = PostProcessConfig()
    merged = stages.merge_time(made, masks, ("2020-04-01", "2020-05-01"), config)
    extent = np.array(merged.where("feature = 'EXTENT_PREDICTED'").first()["px"])
    assert abs(extent[0] - 0.7) < 1e-9  # the median of two scenes, the cloudy one left out
    (row,) = stages.combine(merged, config).collect()
    assert (row["h"], row["w"]) == (16, 16)


def test_vectors_do_not_depend_on_blocks(spark):
    x = np.zeros((12, 20))
    x[2:9, 3:17] = 1.0
    x[4:6, 8:10] = 0.0
    tiles = spark.createDataFrame([("z", 0, 0, 12, 20, x.ravel().tolist())], "zone string, g_row int, g_col int, h int, w int, px array<double>")
    areas = []
    for size in (5, 50):
        out = stages.vectors(tiles, VectorisationConfig(shape=(12, 20), buffer=(1, 1), chunk_size=size, threshold=0.5)).collect()
        areas.append((len(out), round(out[0]["area"], 6), len(out[0]["rings"])))
    assert areas[0] == areas[1] and areas[0][0] == 1 and areas[0][2] == 2


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("t", dt.datetime(2020, 1, d), 0.5) for d in (1, 1, 20)], "tile string, ts timestamp, cloud double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.scene_counts(ingest.arrivals(spark, str(tmp_path / "in"), "tile string, ts timestamp, cloud double"))
    ingest.drain(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).where(F.col("n") == 2).collect()
    assert len(got) == 1
