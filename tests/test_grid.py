"""Grids over areas, block-wise upsampling, stable shuffling, tiles that arrive piece by piece."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dissolve import layer, regular
from test_rings import drawn

from parcelight.functions import kernels, planar
from parcelight.operators import focal, grid, training
from parcelight.streaming import ingest


def test_tiles_of_an_area(spark):
    coast = [(5 + (4 + k % 2) * math.cos(k * math.pi / 9), 5 + (4 + k % 2) * math.sin(k * math.pi / 9)) for k in range(18)]
    area = [[coast, regular(5, 5, 1.2, 5, 0.2)[::-1]], [[(20, 0), (22, 0), (22, 2), (20, 2)]]]
    out = grid.tiles(layer(spark, area), 1.0).collect()
    assert abs(sum(r["area"] for r in out) - sum(map(planar.area, area))) < 1e-4
    assert all(abs(planar.area(g) - r["area"]) < 1e-5 for r, g in zip(out, drawn(out), strict=True))
    for r, g in zip(out, drawn(out), strict=True):
        assert all(r["x0"] - 1e-6 <= x <= r["x1"] + 1e-6 and r["y0"] - 1e-6 <= y <= r["y1"] + 1e-6 for ring in g for x, y in ring)
    assert sum(r["whole"] for r in out) > 20 and {(r["tile_row"], r["tile_col"]) for r in out if r["tile_col"] > 15} == {(0, 20), (0, 21), (1, 20), (1, 21)}


def test_tiles_across_zones(spark):
    """An area on both sides of the border of zones 34 and 35, and one across the equator."""
    area = [[[(23.6, 55.0), (24.3, 55.0), (24.3, 55.4), (23.6, 55.4)]], [[(25.0, -0.1), (25.2, -0.1), (25.2, 0.1), (25.0, 0.1)]]]
    out = grid.zone_tiles(layer(spark, area), 10_000.0).collect()
    sizes = {z: sum(r["area"] for r in out if r["epsg"] == z) / 1e6 for z in {r["epsg"] for r in out}}
    assert set(sizes) == {32634, 32635, 32735}
    km = math.cos(math.radians(55.2)) * 111.32
    assert abs(sizes[32634] - 0.4 * km * 0.4 * 111.3) < 12 and abs(sizes[32635] - 0.3 * km * 0.4 * 111.3 - 0.2 * 111.3 * 0.1 * 111) < 20
    assert len({r["name"] for r in out}) >= 20 and grid.zone_tiles(layer(spark, area).where("false"), 10_000.0).count() == 0


@pytest.mark.parametrize("size", [4, 7, 100])
@pytest.mark.parametrize(("scale", "radius"), [(2, 2), (2, 3), (3, 1)])
def test_upsampling_in_blocks(spark, size, scale, radius):
    rnd = np.random.default_rng(size)
    tiles = [(k, *x.shape, x.ravel().tolist(), y.ravel().tolist()) for k, (x, y) in enumerate([(rnd.random((17, 21)), rnd.random((17, 21)).round()), (rnd.random((5, 9)), np.zeros((5, 9)))])]
    out = focal.upsampled(spark.createDataFrame(tiles, "tile int, h int, w int, e array<double>, b array<double>"), ["tile"], size, scale, radius).collect()
    for k, h, w, e, b in tiles:
        want = kernels.combine_upsample(np.array(e).reshape(h, w), np.array(b).reshape(h, w), scale, radius)
        mine = np.full(want.shape, np.nan)
        for r in out:
            if r["tile"] == k:
                mine[r["top"] : r["top"] + r["h"], r["left"] : r["left"] + r["w"]] = np.reshape(r["px"], (r["h"], r["w"]))
        assert np.abs(mine - want).max() < 1e-12


def test_a_tile_of_one_value(spark):
    tiles = spark.createDataFrame([(1, 4, 4, [0.5] * 16, [0.0] * 16)], "tile int, h int, w int, e array<double>, b array<double>")
    assert all(v is None for r in focal.upsampled(tiles, ["tile"], 4).collect() for v in r["px"])


def test_order_is_drawn_anew_and_stays(spark):
    rows = spark.range(500).select("id", (F.col("id") % 25).alias("chunk"), F.floor(F.col("id") / 25).alias("pos"))
    order = lambda df, **k: [r["id"] for r in training.shuffled(df, ["id"], **k).collect()]
    first = order(rows, seed=1)
    assert first == order(rows.repartition(7, "pos").sortWithinPartitions("chunk"), seed=1) != order(rows, seed=1, epoch=1)
    assert sorted(first) == list(range(500)) and first != order(rows, seed=2)
    got = [r for r in training.interleaved(rows, "chunk", "pos", 4, 5, seed=1).orderBy("stage", "turn", "lane", "pos").collect()]
    again = training.interleaved(rows.repartition(3), "chunk", "pos", 4, 5, seed=1).orderBy("stage", "turn", "lane", "pos").collect()
    assert got == again and len(got) == 500
    for a, b in zip(got[::5], got[4::5], strict=True):  # five rows of a chunk, then the next one's
        assert a["chunk"] == b["chunk"] and b["pos"] - a["pos"] == 4
    other = {(r["chunk"], r["stage"]) for r in training.interleaved(rows, "chunk", "pos", 4, 5, seed=1, epoch=1).collect()}
    assert other != {(r["chunk"], r["stage"]) for r in got}


def test_tiles_are_complete_once(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 5, 1) + dt.timedelta(hours=h, minutes=m)
    files = [
        [("A", "B02", at(8)), ("A", "B03", at(8)), ("B", "B02", at(8)), ("C", "B04", at(8)), ("C", "XX", at(8))],
        [("A", "B04", at(8, 5)), ("B", "B02", at(8, 5))],
        [("A", "B02", at(8, 20)), ("C", "B02", at(8, 30)), ("C", "B03", at(8, 30))],
        [("D", "B02", at(12))],
        [("D", "B03", at(12, 5)), ("D", "B04", at(12, 5))],
        [("E", "B02", at(20))],
    ]
    stream = lambda: ingest.complete_tiles(ingest.arrivals(spark, str(tmp_path / "in"), "tile string, band string, ts timestamp", 1), ["B02", "B03", "B04"])
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, "tile string, band string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.drain(stream(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()  # each run goes on where the last one ended
    got = sorted((r["tile"], r["status"], tuple(r["missing"])) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("A", "complete", ()), ("B", "failed", ("B03", "B04")), ("C", "complete", ()), ("D", "complete", ())]


def test_tiles_are_worked_on_in_portions():
    import pandas as pd

    from parcelight.operators import focal

    b = pd.DataFrame({"h": [8] * 5000 + [600], "w": [8] * 5000 + [600], "n": range(5001)})
    parts = list(focal.portions(b, 16))
    assert pd.concat(parts)["n"].tolist() == list(range(5001))
    assert max(int((p["h"] * p["w"]).sum()) * 16 for p in parts if len(p) > 1) <= 2 * focal.PIXELS and len(parts) > 15
    assert [len(p) for p in focal.portions(b.head(0))] in ([], [0])
