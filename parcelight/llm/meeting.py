"""Rows that share a key and must be compared across their roots: how they are dealt out, and paired inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frames, lean, ranges

#: Rows of a key that meet in one place at most, rows read at a time, and pairs compared at a time.
BLOCK, ROWS, PAIRS = 2048, 50_000, 1 << 19
CELL = ("key", "i", "j")


def dealt(index: DataFrame, block: int = BLOCK) -> DataFrame:
    """index (key, node, root and others) in cells (i, j) of at most about 2 * block rows: two rows of a key with
    different roots meet in at least one cell.

    Keys all of whose rows have one root are left out. Up to block rows a key is one cell. Beyond it, rows of the key's
    most common root need not meet one another: all rows are dealt into blocks, the rows of other roots into others, and
    each block of the one kind meets each of the other.
    """
    by_root = index.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    keys = by_root.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top")).where("roots > 1")
    cells = keys.select("key", F.col("top.root").alias("main"), F.when(F.col("n") <= block, 1).otherwise(F.ceil(F.col("n") / block)).cast("int").alias("all_"), F.when(F.col("n") <= block, 0).otherwise(F.ceil((F.col("n") - F.col("top.n")) / block)).cast("int").alias("rest"))
    rows = index.join(cells, "key")
    at = lambda c, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.greatest(F.col(c), F.lit(1))).cast("int")
    every = lambda c: F.sequence(F.lit(0), F.greatest(F.col(c), F.lit(1)) - 1)
    one = F.array(F.struct(at("all_", 3).alias("i"), F.lit(0).alias("j")))
    whole = F.transform(every("rest"), lambda j: F.struct(at("all_", 3).alias("i"), j.cast("int").alias("j")))
    other = F.transform(every("all_"), lambda i: F.struct(i.cast("int").alias("i"), at("rest", 4).alias("j")))
    where = F.when(F.col("rest") == 0, one).when(F.col("root") == F.col("main"), whole).otherwise(F.array_distinct(F.concat(whole, other)))
    return rows.select(*index.columns, F.explode(where).alias("cell")).select(*index.columns, "cell.i", "cell.j")


def pairs(cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places with equal cell, in portions; equal ones stand together."""
    n = len(cell)
    last = np.flatnonzero(np.concatenate((cell[1:] != cell[:-1], [True])))
    rest = np.repeat(last, np.diff(np.concatenate(([-1], last)))) - np.arange(n)
    total = np.cumsum(rest)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        some = np.arange(at, to)
        if rest[at:to].any():
            yield np.repeat(some, rest[at:to]), ranges(some + 1, rest[at:to])
        at = to


def numbered(t: pa.Table, key: tuple[str, ...]) -> np.ndarray:
    """The number of each row's group; rows are sorted by the key."""
    columns = [t[c].to_numpy() for c in key]
    return np.cumsum(np.concatenate(([False], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges that connect the same: each end with the least one it is connected to."""
    ends, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ends))
    while True:
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if (label[x] == label[y]).all() and (label[label] == label).all():
            break
    some = label != np.arange(len(ends))
    return ends[label[some]], ends[some]


def connected_near(index: DataFrame, key: tuple[str, ...], bits: int) -> DataFrame:
    """a, b: roots of rows (node: fingerprint, root) in one group of the key whose fingerprints differ in at most bits
    bits; not all such pairs, but as many as connect the same roots. A group has a bounded number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in frames(batches, ROWS, key):
            fp, root = t["node"].to_numpy().view(np.uint64), t["root"].to_numpy()
            a = b = np.zeros(0, np.int64)
            for i, j in pairs(numbered(t, key)):
                near = (np.bitwise_count(fp[i] ^ fp[j]) <= bits) & (root[i] != root[j])
                if near.any():
                    a, b = stars(np.concatenate((a, root[i[near]])), np.concatenate((b, root[j[near]])))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return index.repartition(*key).sortWithinPartitions(*key).mapInArrow(lean(run), "a long, b long")
