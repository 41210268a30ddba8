"""TIFF files: round trips through the source, forms that other programs write, and reads of touched strips only."""

import struct
import zlib

import numpy as np
import pytest

from parcelight.sources import tiff


def reader(raw, seen=None):
    def read(at, n):
        if seen is not None:
            seen.append((at, n))
        return raw[at : at + n]

    return read


def whole(raw):
    head = tiff.header(reader(raw))
    out = np.full((head.samples, head.height, head.width), np.nan)
    for b in head.blocks:
        for band, x in tiff.pixels(head, b, raw[b[3] : b[3] + b[4]]):
            out[band, b[1] : b[1] + x.shape[0], b[2] : b[2] + x.shape[1]] = x
    return head, out


@pytest.mark.parametrize("dtype", ["f4", "f8", "u1", "u2", "i4"])
def test_codec(dtype):
    rnd = np.random.default_rng(1)
    bands = [(rnd.random((37, 23)) * 200).astype(dtype) for _ in range(3)]
    raw = tiff.encoded(bands, dtype, 500000.0, 6100000.0, 10.0, 32634, strip=700)
    head, out = whole(raw)
    assert len(head.blocks) > 1 and (out == np.stack(bands)).all()
    assert (head.x0, head.y1, head.resolution, head.epsg) == (500000.0, 6100000.0, 10.0, 32634)
    assert whole(tiff.encoded([bands[0]], dtype))[0].epsg is None


def built(order, tags, data):
    """A file by hand: tags {tag: (kind letter, values)}, offsets counted from the data, which follows the head."""
    types = {v: k for k, v in tiff.KINDS.items()}
    n = len(tags)
    at = 8 + 2 + 12 * n + 4
    extra = sum(s + s % 2 for s in (struct.calcsize(f"{order}{len(v)}{k}") for k, v in tags.values()) if s > 4)
    entries, body = b"", b""
    for tag in sorted(tags):
        kind, v = tags[tag]
        if tag in (tiff.OFFSETS, tiff.TILE_OFFSETS):
            v = [x + at + extra for x in v]
        raw = struct.pack(f"{order}{len(v)}{kind}", *v)
        if len(raw) > 4:
            raw, body = struct.pack(order + "I", at + len(body)), body + raw + b"\0" * (len(raw) % 2)
        entries += struct.pack(order + "HHI", tag, types[kind], len(v)) + raw.ljust(4, b"\0")
    return struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 8) + struct.pack(order + "H", n) + entries + bytes(4) + body + data


@pytest.mark.parametrize("order", ["<", ">"])
def test_tiles_planes_and_predictor(order):
    x = np.arange(2 * 20 * 24).reshape(2, 20, 24) * 7 % 251
    parts = []
    for plane in x:
        for r in (0, 16):
            for c in (0, 16):
                tile = np.zeros((16, 16), order + "u2")
                some = plane[r : r + 16, c : c + 16]
                tile[: some.shape[0], : some.shape[1]] = some
                diff = tile.copy()
                diff[:, 1:] = tile[:, 1:] - tile[:, :-1]
                parts.append(zlib.compress(diff.tobytes()))
    offsets = np.cumsum([0, *map(len, parts)])[:-1].tolist()
    tags = {tiff.WIDTH: ("H", [24]), tiff.HEIGHT: ("H", [20]), tiff.BITS: ("H", [16, 16]), tiff.COMPRESSION: ("H", [tiff.OLD_DEFLATE]), tiff.SAMPLES: ("H", [2]), tiff.PLANAR: ("H", [2]), tiff.PREDICTOR: ("H", [2]), tiff.TILE_WIDTH: ("H", [16]), tiff.TILE_HEIGHT: ("H", [16]), tiff.TILE_OFFSETS: ("I", offsets), tiff.TILE_COUNTS: ("I", [len(p) for p in parts])}
    head, out = whole(built(order, tags, b"".join(parts)))
    assert head.tiled and head.planes and (out == x).all()


def test_plain_strips_and_bad_files():
    x = np.arange(35, dtype=">i2").reshape(7, 5)
    tags = {tiff.WIDTH: ("H", [5]), tiff.HEIGHT: ("H", [7]), tiff.BITS: ("H", [16]), tiff.FORMAT: ("H", [2]), tiff.ROWS: ("H", [3]), tiff.OFFSETS: ("I", [0, 30, 60]), tiff.COUNTS: ("I", [30, 30, 10])}
    raw = built(">", tags, x.tobytes())
    assert (whole(raw)[1][0] == x).all()
    with pytest.raises(ValueError, match="not a TIFF"):
        tiff.header(reader(b"PK\3\4" + bytes(20)))
    with pytest.raises(ValueError, match="not understood"):
        tiff.header(reader(built("<", tags | {tiff.COMPRESSION: ("H", [5])}, x.tobytes())))


def test_only_touched_strips_are_read(tmp_path, monkeypatch):
    x = np.random.default_rng(2).random((100, 50))
    (tmp_path / "a.tiff").write_bytes(tiff.encoded([x], "f8", strip=10 * 50 * 8))
    seen = []
    source = tiff.Reader({"path": str(tmp_path), "row0": "35", "row1": "47"})
    opened = source.open
    monkeypatch.setattr(source, "open", lambda p: ((lambda at, n, r=opened(p): (seen.append((at, n)), r[0](at, n))[1]), opened(p)[1]))
    (part,) = source.partitions()
    got = [b for batch in source.read(part) for b in batch.to_pylist()]
    assert [b["top"] for b in got] == [30, 40] and np.allclose(np.concatenate([np.array(b["px"]).reshape(b["h"], b["w"]) for b in got]), x[30:50])
    strips = {(b[3], b[4]) for b in tiff.header(opened(str(tmp_path / "a.tiff"))[0]).blocks}
    assert len(strips & set(seen)) == 2


def test_source_and_writer(spark, tmp_path):
    spark.dataSource.register(tiff.Tiff)
    rnd = np.random.default_rng(3)
    images = {f"t{k}.tiff": (rnd.random((40 + k, 30)), rnd.random((40 + k, 30))) for k in range(5)}
    rows = [(n, x.shape[0], x.shape[1], [x.ravel().tolist(), y.ravel().tolist()], 1000.0 * k, 2000.0, 10.0, 32634) for k, (n, (x, y)) in enumerate(images.items())]
    rasters = spark.createDataFrame(rows, "name string, h int, w int, bands array<array<double>>, x0 double, y1 double, resolution double, epsg int")
    folder = str(tmp_path / "out")
    rasters.write.format("tiff").option("dtype", "f8").mode("append").save(folder)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(images)
    again = spark.read.format("tiff").option("blockBytes", "1000").load(folder)
    assert again.rdd.getNumPartitions() >= 5
    for r in tiff.assembled(again).collect():
        assert np.array_equal(np.array(r["px"]).reshape(r["h"], r["w"]), images[r["file"]][r["band"]])
    assert {(r["x0"], r["epsg"]) for r in again.select("x0", "epsg").distinct().collect()} == {(1000.0 * k, 32634) for k in range(5)}
    by_spark = tiff.decoded(spark.read.format("binaryFile").load(folder))
    assert by_spark.count() == again.count()
