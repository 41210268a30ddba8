"""What the corpus operators share: column handling, words, checkpoints."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import checkpoint_folder, dropped  # noqa: F401

#: Words are runs of anything but space and the ASCII controls 09 to 0D; ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder, which survives the loss of executors, and go on from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: A table of no more rows than this may be sent to all executors.
FEW = 100_000


def small(df: DataFrame) -> DataFrame:
    """df (a written table, so that counting is cheap), to be broadcast in joins if it has few rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def numbered(rows: DataFrame, name: str = "nth", chunk: int = 1 << 16) -> DataFrame:
    """rows with a number from 0 that tells equal ones apart. Equal rows are counted and dealt out again, in chunks, so no
    task meets all copies of one; the columns' names must not begin with an underscore."""
    counted = cut(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")))
    n, part = F.col("_n"), F.col("_part")
    out = counted.where(n <= chunk).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).drop("_n")
    many = counted.where(n > chunk)
    if many.isEmpty():
        return out
    parts = many.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk)))).repartition(*rows.columns, "_part")
    return out.unionByName(parts.withColumn(name, F.explode(F.sequence(part * chunk, F.least(n, (part + 1) * chunk) - 1))).drop("_n", "_part"))


def unsigned_fraction(*cols: Column) -> Column:
    """A fixed number in [0, 1) for each value of the columns, the same on every run."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
_tool: dict[Hashable, object] = {}


def tool(key: Hashable, make: Callable[[], object]) -> object:
    """What make() gives: made once in a worker process, and held until a task asks for another or for none."""
    if key not in _tool:
        _tool.clear()
        _tool[key] = make()
    return _tool[key]


#: Bytes from which on an array has pages of its own, and glibc's name for that setting.
OWN_PAGES, M_MMAP_THRESHOLD = 1 << 20, -3


def own_pages() -> None:
    """Let arrays of a MB and more go back to the system as soon as they are freed. By default the limit rises with what has
    been freed, up to 32 MB, and arrays of that size then stay in the process."""
    if hasattr(ctypes.CDLL(None), "mallopt"):
        ctypes.CDLL(None).mallopt(M_MMAP_THRESHOLD, OWN_PAGES)


def trim() -> None:
    """Give memory that is no longer used back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of a batch on its way between an executor and its Python workers. By default only rows are counted, and 10,000
#: texts of some KB lie in buffers of both.
BATCH = "4m"


def lean(run: Batches, tools: bool = False) -> Batches:
    """run, for mapInArrow. Worker processes outlive their tasks, so what each operator leaves in them would add up beside
    the executor's heap: unused memory is given back at a task's end, and what ``tool`` holds as well, unless run has use
    for it. The session is set to batches of a few MB."""
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_pages()
        if not tools and _tool:
            _tool.clear()
            trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return task


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is the empty text."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


#: Bytes of text that a task works on at a time; its arrays take some 30 times as much.
PART = 2 << 20


def in_parts(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = PART) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about limit bytes of text each, so that work arrays stay small."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
        start = held = 0
        for i, x in enumerate(sizes):
            held += 0 if not x.is_valid else len(x.as_buffer())
            if held >= limit:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def packed(docs: DataFrame) -> DataFrame:
    """docs (doc, mark, text) with the text's bytes compressed, as they travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in in_parts(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([pack(t) for t in texts(batch)], pa.binary())], ["doc", "mark", "z"])

    return docs.mapInArrow(lean(run), "doc long, mark long, z binary")


def unpacked(batches: Iterator[pa.RecordBatch], limit: int = PART) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the texts of their column z; about limit bytes of text each, however small they travel."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        start, held, raws = 0, 0, []
        for i, z in enumerate(batch.column(batch.schema.get_field_index("z"))):
            raws.append(unpack(z.as_buffer()))
            held += len(raws[-1])
            if held >= limit or i + 1 == batch.num_rows:
                yield batch.slice(start, i + 1 - start), raws
                start, held, raws = i + 1, 0, []


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for length[0] numbers, then those of the next."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def frames(batches: Iterator[pa.RecordBatch], rows: int, key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of about that many rows which end between groups of equal key; the batches are sorted by the key."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            whole = pa.Table.from_batches(held).combine_chunks()
            last = whole.num_rows
            columns = [whole[c].to_numpy() for c in key]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
            last = int(change[-1]) + 1 if len(change) else 0
            if last:
                yield whole.slice(0, last)
            held = whole.slice(last).to_batches()
            count = whole.num_rows - last
    if count:
        yield pa.Table.from_batches(held).combine_chunks()
