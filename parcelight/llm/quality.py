"""Quality scores from supervised subword embeddings.

Each word has a hashed vector, and so has each of its character n-grams; a document is the mean of all of them, and a
softmax over two outputs gives the score. A word that repeats the one before has a feature of its own. Vectors and
outputs are learned together by stochastic gradient descent in numpy. As the output is linear in the mean, a trained
model keeps one number for each hashed feature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_parts, lean, texts, tool, unsigned_fraction

#: Hashed features (a power of two), vector size, n-gram lengths in characters, and the words hashed at a time.
BITS, SIZE, GRAMS, STEP = 17, 12, (2, 3, 4), 100_000
BUCKETS = 1 << BITS
EPOCHS, RATE, SEED = 4, 0.5, 3
#: Odd factors of a gram's code points, and of its hash.
FACTORS, MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32), np.uint32(0x165667B1)
#: A text of a few words says little: as many features that speak for neither label are added when scoring.
PRIOR = 15
#: The feature of a word that repeats the one before it.
AGAIN = zlib.crc32(b"<again>") % BUCKETS


def features(text: bytes) -> Iterator[np.ndarray]:
    """The hashed features of a text, as often as they occur, in parts: of each word itself and its n-grams, where the
    spaces around a word count as its first and last character."""
    words, crc = text.split(), zlib.crc32
    for at in range(0, len(words), STEP):
        some = words[at : at + STEP]
        wide = np.frombuffer((b" " + b" ".join(some) + b" ").decode().encode("utf-32-le"), np.uint32)
        inner = wide != 32
        out = [np.array([crc(w) for w in some], np.uint32) & np.uint32(BUCKETS - 1), np.full(sum(map(eq, some, words[at + 1 : at + 1 + STEP])), AGAIN, np.uint32)]
        for n in GRAMS:
            size = len(wide) - n + 1
            if size < 1:
                continue
            h, ok = np.full(size, n, np.uint32), np.ones(size, bool)
            for k in range(n):
                h += wide[k : k + size] * FACTORS[k]
                h ^= h >> np.uint32(15)
                if 0 < k < n - 1:
                    ok &= inner[k : k + size]
            out.append((h[ok] * MIX) >> np.uint32(32 - BITS))
        yield np.concatenate(out)


@dataclass(frozen=True)
class Model:
    """weight[f]: what feature f adds to the difference of the outputs when it is the whole document."""

    weight: bytes
    bias: float


class Scorer:
    def __init__(self, model: Model) -> None:
        self.weight, self.bias = np.frombuffer(model.weight, np.float32), model.bias

    def score(self, text: bytes) -> float:
        total, n = 0.0, 0
        for ids in features(text):
            total += float(self.weight[ids].sum(dtype=np.float64))
            n += len(ids)
        return float(1 / (1 + np.exp(-np.clip(total / (n + PRIOR) + self.bias, -40, 40))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """rows: feature ids, how often each occurs, label 0 or 1. The order of the rows matters, and nothing else random."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    out = np.zeros((2, SIZE), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            ids, times, label = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            share = (times / max(times.sum(), 1)).astype(np.float32)
            mean = share @ vectors[ids]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            error = -p
            error[label] += 1
            back = error @ out
            out += rate * np.outer(error, mean)
            bias += rate * 0.1 * error
            vectors[ids] += rate * share[:, None] * back * np.float32(min(len(ids), 200))
    return Model((vectors @ (out[1] - out[0])).astype(np.float32).tobytes(), float(bias[1] - bias[0]))


def learn(labelled: DataFrame, sample: int = 5000, docs: DataFrame | None = None) -> Model:
    """A model from labelled (text, quality; or with docs, which has doc_id and text: doc_id, by, the XXH64 of the text, and
    quality, so that only the texts that are drawn are joined to anything): about ``sample`` distinct texts drawn by hash, all if there are fewer, whole.

    A text that is repeated teaches its labels once, so no text outweighs others and none is drawn with all its copies.
    Rows without a label teach nothing; null texts count as empty. Executors send back hashed features with their
    counts, so what the driver holds is bounded by the sample and the number of features.
    """
    named = [F.col("text"), F.xxhash64("text").alias("by")] if docs is None else [F.col("doc_id"), F.col("by")]
    rows = labelled.where("quality in (0, 1)").select(*named, F.col("quality").cast("int").alias("quality"))
    n = rows.agg(F.approx_count_distinct("by")).first()[0]
    drawn = rows.where(unsigned_fraction(F.col("by"), F.lit(5)) < min(1.0, sample / max(n, 1))).dropDuplicates(["by", "quality"])
    if docs is not None:
        hashed = docs.select(F.col("doc_id").alias("its_id"), "text", F.xxhash64("text").alias("its_hash"))
        drawn = hashed.join(F.broadcast(drawn), (F.col("its_id") == F.col("doc_id")) & (F.col("its_hash") == F.col("by"))).dropDuplicates(["by", "quality"])  # about sample rows
    drawn = drawn.select("text", "quality")
    schema = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("times", T.BinaryType()), T.StructField("quality", T.IntegerType()), T.StructField("by", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            out = []
            for t, q in zip(texts(batch), batch.column(1).to_pylist(), strict=True):
                times = sum((np.bincount(ids, minlength=BUCKETS) for ids in features(t)), np.zeros(BUCKETS, np.int64))
                u = np.flatnonzero(times)
                out.append((u.astype(np.int32).tobytes(), times[u].astype(np.int32).tobytes(), q, zlib.crc32(t)))
            if out:
                a, b, c, d = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c, pa.int32()), pa.array(d, pa.int64())], ["ids", "times", "quality", "by"])

    got = sorted(drawn.mapInArrow(lean(run), schema).collect(), key=lambda r: (r["by"], r["quality"], bytes(r["ids"])))
    return train([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["times"], np.int32), r["quality"]) for r in got])


def scorer(model: Broadcast) -> Scorer:
    """One scorer for each worker process."""
    return tool(("scorer", hash(model.value)), lambda: Scorer(model.value))


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs without the text, with score (0 to 1, higher: label 1 likelier) and predicted (1 from ``threshold``) added.

    Null and empty texts get the score of the bias alone. Nothing is shuffled, rows stay as they are, and columns named
    score or predicted are replaced. Whole texts are scored, however long.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of the number of features
    rest = [c for c in docs.columns if c not in (text_col, "score", "predicted")]
    kinds = dict(docs.dtypes)
    base = docs.select(*rest, F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer(shared)
        for batch in in_parts(batches):
            found = [s.score(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64()), pa.array([int(x >= threshold) for x in found], pa.int32())], [*rest, "score", "predicted"])

    return base.mapInArrow(lean(run, tools=True), ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "score double, predicted int"]))
