"""TIFF rasters: a data source that reads strips or tiles as partitions, a writer, and a codec for files in binary columns.

``spark.read.format("tiff").load(path)`` gives a row for each band of each strip or tile, with its place in the raster;
the options row0 and row1 leave out blocks beyond these rows, whose bytes are then not read. ``write.format("tiff")``
writes a file for each row of rasters. Both open files by pyarrow's file systems; where only Spark reaches a store, its
``binaryFile`` source and ``decoded`` do.

Understood are strips and tiles of whole numbers and floats, plain or deflated, with or without the horizontal predictor,
bands pixel by pixel or plane by plane, both byte orders, and of geographic tags the upper left corner, the resolution
and the EPSG code.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Tags (fixed values of the format).
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT, SCALE, TIE_POINT, GEO_KEYS, PROJECTED = 322, 323, 324, 325, 339, 33550, 33922, 34735, 3072
#: Letters of the field types (fixed values of the format).
KINDS = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946

SCHEMA = "file string, band int, top int, left int, h int, w int, px array<double>, height int, width int, x0 double, y1 double, resolution double, epsg int"
Read = Callable[[int, int], bytes]


@dataclass(frozen=True)
class Header:
    """What a file's directory says; blocks: (band or -1, top, left, offset, size) of strips and tiles."""

    order: str
    height: int
    width: int
    tiled: bool
    block: tuple[int, int]
    samples: int
    planes: bool
    dtype: str
    compression: int
    predictor: int
    x0: float | None
    y1: float | None
    resolution: float | None
    epsg: int | None
    blocks: tuple[tuple[int, int, int, int, int], ...]


def header(read: Read) -> Header:
    """The first directory of a file, by reads of (offset, size)."""
    begin = read(0, 8)
    if begin[:2] not in (b"II", b"MM") or struct.unpack(("<" if begin[:2] == b"II" else ">") + "H", begin[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    order = "<" if begin[:2] == b"II" else ">"
    at = struct.unpack(order + "I", begin[4:8])[0]
    n = struct.unpack(order + "H", read(at, 2))[0]
    entries, tags = read(at + 2, 12 * n), {}
    for k in range(n):
        tag, kind, count = struct.unpack(order + "HHI", entries[12 * k : 12 * k + 8])
        if kind not in KINDS:
            continue
        form = order + f"{count}{KINDS[kind]}"
        size = struct.calcsize(form)
        raw = entries[12 * k + 8 : 12 * k + 12]
        tags[tag] = struct.unpack(form, raw[:size] if size <= 4 else read(struct.unpack(order + "I", raw)[0], size))
    one = lambda tag, default: tags.get(tag, (default,))[0]
    height, width, samples = one(HEIGHT, 0), one(WIDTH, 0), one(SAMPLES, 1)
    dtype = {1: "u", 2: "i", 3: "f"}[one(FORMAT, 1)] + str(one(BITS, 1) // 8)
    if len(set(tags.get(BITS, (1,)))) > 1 or dtype[1:] == "0" or one(COMPRESSION, PLAIN) not in (PLAIN, DEFLATE, OLD_DEFLATE) or one(PREDICTOR, 1) not in (1, 2):
        raise ValueError(f"not understood: {one(BITS, 1)} bits, compression {one(COMPRESSION, PLAIN)}, predictor {one(PREDICTOR, 1)}")
    tiled = TILE_OFFSETS in tags
    block = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)) if tiled else (min(one(ROWS, height), height), width)
    planes = one(PLANAR, 1) == 2 and samples > 1
    corners = [(r, c) for r in range(0, height, block[0]) for c in range(0, width, block[1])]
    places = [(b, r, c) for b in (range(samples) if planes else (-1,)) for r, c in corners]
    parts = zip(tags[TILE_OFFSETS if tiled else OFFSETS], tags[TILE_COUNTS if tiled else COUNTS], strict=True)
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    tie, scale = tags.get(TIE_POINT), tags.get(SCALE)
    known = tie is not None and scale is not None
    return Header(order, height, width, tiled, block, samples, planes, dtype, one(COMPRESSION, PLAIN), one(PREDICTOR, 1), tie[3] - tie[0] * scale[0] if known else None, tie[4] + tie[1] * scale[1] if known else None, scale[0] if known else None, codes.get(PROJECTED), tuple((*p, *q) for p, q in zip(places, parts, strict=True)))


def pixels(head: Header, block: tuple[int, int, int, int, int], raw: bytes) -> list[tuple[int, np.ndarray]]:
    """(band, values) of a block, without what lies beyond the raster."""
    band, top, left, _, _ = block
    if head.compression != PLAIN:
        raw = zlib.decompress(raw)
    h = head.block[0] if head.tiled else min(head.block[0], head.height - top)  # strips end with the raster, tiles do not
    n = 1 if head.planes else head.samples
    x = np.frombuffer(raw, np.dtype(head.order + head.dtype), h * head.block[1] * n).reshape(h, head.block[1], n)
    if head.predictor == 2:
        x = np.cumsum(x, axis=1, dtype=x.dtype.newbyteorder("="))
    x = x[: head.height - top, : head.width - left]
    return [(band if head.planes else k, x[:, :, k]) for k in range(n)]


def rows_of(name: str, head: Header, read: Read, blocks: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    out: list[tuple] = []
    for block in blocks:
        for band, x in pixels(head, block, read(block[3], block[4])):
            out.append((name, band, block[1], block[2], *x.shape, x.astype(float).ravel(), head.height, head.width, head.x0, head.y1, head.resolution, head.epsg))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    i32, f64 = pa.int32(), pa.float64()
    kinds = [pa.string(), i32, i32, i32, i32, i32, pa.list_(f64), i32, i32, f64, f64, f64, i32]
    columns = list(zip(*out, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def wanted(head: Header, row0: int | None, row1: int | None) -> list[tuple[int, int, int, int, int]]:
    """The blocks that have rows from row0 up to row1."""
    return [b for b in head.blocks if (row1 is None or b[1] < row1) and (row0 is None or b[1] + head.block[0] > row0)]


def decoded(files: DataFrame, row0: int | None = None, row1: int | None = None) -> DataFrame:
    """The rows of the source, from files (path, content) as the binaryFile source gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = memoryview(content.as_buffer())
                read = lambda at, n, raw=raw: bytes(raw[at : at + n])
                head = header(read)
                yield rows_of(name, head, read, wanted(head, row0, row1))

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def encoded(bands: list[np.ndarray], dtype: str = "f4", x0: float | None = None, y1: float | None = None, resolution: float | None = None, epsg: int | None = None, strip: int = 1 << 16) -> bytes:
    """A deflated file of bands of one shape, in strips of about so many bytes; with x0, y1 and resolution it has a place."""
    h, w = bands[0].shape
    x = np.ascontiguousarray(np.stack(bands, axis=-1).astype("<" + dtype))
    step = max(1, strip // max(1, w * len(bands) * x.itemsize))
    strips = [zlib.compress(x[r : r + step].tobytes()) for r in range(0, h, step)]
    n = len(bands)
    values = {
        WIDTH: ("I", [w]), HEIGHT: ("I", [h]), BITS: ("H", [8 * x.itemsize] * n), COMPRESSION: ("H", [DEFLATE]), PHOTOMETRIC: ("H", [1]), OFFSETS: ("I", [0] * len(strips)), SAMPLES: ("H", [n]), ROWS: ("I", [step]),
        COUNTS: ("I", [len(s) for s in strips]), PLANAR: ("H", [1]), FORMAT: ("H", [{"u": 1, "i": 2, "f": 3}[dtype[0]]] * n),
    }
    if x0 is not None and y1 is not None and resolution is not None:
        values |= {SCALE: ("d", [resolution, resolution, 0.0]), TIE_POINT: ("d", [0.0, 0.0, 0.0, x0, y1, 0.0])}
    if epsg is not None:
        values[GEO_KEYS] = ("H", [1, 1, 0, 2, 1024, 0, 1, 1, PROJECTED, 0, 1, epsg])
    types = {v: k for k, v in KINDS.items()}
    at = 8 + 2 + 12 * len(values) + 4
    place, outside = {}, b""
    for tag in sorted(values):
        size = struct.calcsize(f"<{len(values[tag][1])}{values[tag][0]}")
        if size > 4:
            place[tag] = at + len(outside)
            outside += bytes(size + size % 2)
    first = at + len(outside)
    values[OFFSETS] = ("I", list(first + np.cumsum([0, *map(len, strips)])[:-1]))
    entries, body = b"", bytearray(outside)
    for tag in sorted(values):
        kind, v = values[tag]
        raw = struct.pack(f"<{len(v)}{kind}", *v)
        if tag in place:
            body[place[tag] - at : place[tag] - at + len(raw)] = raw
            raw = struct.pack("<I", place[tag])
        entries += struct.pack("<HHI", tag, types[kind], len(v)) + raw.ljust(4, b"\0")
    return struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(values)) + entries + struct.pack("<I", 0) + bytes(body) + b"".join(strips)


def files_of(rasters: DataFrame, dtype: str = "f4") -> DataFrame:
    """path, content of a file for each row of rasters: name, h, w, px (row by row) or bands (an array of such), and x0, y1,
    resolution, epsg where they have a place."""
    names = rasters.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [content_of(r, dtype) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(names.index("name")).cast(pa.string()), pa.array(made, pa.binary())], ["path", "content"])

    return rasters.mapInArrow(run, "path string, content binary")


def content_of(row: dict, dtype: str) -> bytes:
    bands = row["bands"] if row.get("bands") is not None else [row["px"]]
    shaped = [np.asarray(v, float).reshape(row["h"], row["w"]) for v in bands]
    return encoded(shaped, dtype, *(row.get(c) for c in ("x0", "y1", "resolution", "epsg")))


@dataclass
class Blocks(InputPartition):
    path: str
    blocks: list[tuple[int, int, int, int, int]]


class Reader(DataSourceReader):
    """A partition for each run of blocks of about the option blockBytes (16 MB) in a file."""

    def __init__(self, options: dict) -> None:
        self.path, self.options = options["path"], dict(options)

    def open(self, path: str) -> tuple[Read, pa.NativeFile]:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        file = system.open_input_file(inner)
        return (lambda at, n: file.read_at(n, at)), file

    def listed(self) -> list[str]:
        from pyarrow import fs

        uri = "://" in self.path or self.path.startswith("file:")
        system, inner = fs.FileSystem.from_uri(self.path) if uri else (fs.LocalFileSystem(), self.path)
        found = system.get_file_info(inner)
        if found.type == fs.FileType.File:
            return [self.path]
        files = [f.path for f in system.get_file_info(fs.FileSelector(inner, recursive=True)) if f.is_file and f.extension.lower() in ("tif", "tiff")]
        return sorted(self.path[: len(self.path) - len(inner)] + f if uri else f for f in files)

    def partitions(self) -> list[InputPartition]:
        most = int(self.options.get("blockBytes", 16 << 20))
        row = lambda k: int(self.options[k]) if k in self.options else None
        out: list[InputPartition] = []
        for path in self.listed():
            read, file = self.open(path)
            with file:
                blocks, held, size = wanted(header(read), row("row0"), row("row1")), [], 0
            for b in blocks:
                held.append(b)
                size += b[4]
                if size >= most:
                    out.append(Blocks(path, held))
                    held, size = [], 0
            if held:
                out.append(Blocks(path, held))
        return out or [Blocks("", [])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        read, file = self.open(partition.path)
        with file:
            head = header(read)
            for block in partition.blocks:
                yield rows_of(partition.path.rsplit("/", 1)[-1], head, read, [block])


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class Writer(DataSourceArrowWriter):
    """Files get their names when all tasks have ended well, so a task that is run again leaves no part of one."""

    def __init__(self, options: dict) -> None:
        self.path, self.dtype = options["path"], options.get("dtype", "f4")

    def place(self) -> tuple:
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, inner = self.place()
        system.create_dir(inner)
        out = []
        for batch in iterator:
            for row in batch.to_pylist():
                held = f"{inner}/.{uuid.uuid4().hex}"
                with system.open_output_stream(held) as f:
                    f.write(content_of(row, self.dtype))
                out.append((held, f"{inner}/{row['name']}"))
        return Written(out)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = self.place()
        for m in messages:
            for held, name in m.files if m else []:
                system.move(held, name)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = self.place()
        for m in messages:
            for held, _name in m.files if m else []:
                system.delete_file(held)


class Tiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:  # noqa: ANN001
        return Writer(self.options)


def assembled(blocks: DataFrame) -> DataFrame:
    """file, band, h, w, px of whole rasters, from the source's rows; for rasters that fit into a task."""
    lines = F.posexplode(F.transform(F.sequence(F.lit(0), F.col("h") - 1), lambda r: F.slice("px", (r * F.col("w") + 1).cast("int"), F.col("w"))))
    cut = blocks.select("file", "band", "top", "left", "height", "width", lines.alias("r", "line"))
    listed = cut.groupBy("file", "band", "height", "width").agg(F.array_sort(F.collect_list(F.struct((F.col("top") + F.col("r")).alias("row"), "left", "line"))).alias("all"))
    return listed.select("file", "band", F.col("height").alias("h"), F.col("width").alias("w"), F.flatten(F.transform("all", lambda x: x["line"])).alias("px"))
