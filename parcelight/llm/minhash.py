"""MinHash document fingerprints over word shingles.

A shingle is five lower-cased words, hashed once; ``PERMUTATIONS`` universal hash functions (multiply-add on 64 bits, of
which the top 32 count) order the shingles, and the least value of each is the signature. Of these, 16 bits are kept.
The part of equal entries of two signatures estimates the Jaccard similarity of the shingle sets. Near duplicates are
found by joining bands of signature entries, and verified on the shingle sets themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, in_parts
from .components import components

PERMUTATIONS, WORDS = 128, 5
_random = np.random.default_rng(4)
A = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
B = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64)[:, None]
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Shingles hashed at a time.
STEP = 1024


def shingles(text: bytes, size: int = WORDS) -> np.ndarray:
    """A 64-bit hash of each run of size words; of all the words if there are fewer, none if there are no words."""
    words = text.lower().split()
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    k = min(size, len(h))
    if not k:
        return h
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * MIX
        out ^= out >> np.uint64(32)
    return out


def signature(h: np.ndarray) -> np.ndarray:
    """The least value of each permutation, 16 bits of it; all ones without shingles."""
    least = np.full(PERMUTATIONS, ~np.uint64(0))
    for at in range(0, len(h), STEP):
        x = A * h[None, at : at + STEP]
        x += B
        np.minimum(least, x.min(axis=1), out=least)
    return (((least >> np.uint64(32)) * MIX) >> np.uint64(48)).astype(np.uint16) if len(h) else np.full(PERMUTATIONS, 0xFFFF, np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def packed(s: np.ndarray) -> bytes:
    return s.astype(">u2").tobytes()


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first characters of the following one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


FIELDS = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    new = edited(text, following)
    raw = new.encode()
    s = signature(shingles(raw)) if new != text else own
    return len(text), hashlib.sha256(raw).digest(), packed(own), packed(s), likeness(own, s), likeness(own, other)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    A text's edited form ends in the beginning of the next one by falling id; after the last comes the first. Rows are
    dealt by ranges of id and hash and sorted, so the next row is at hand; only for the last row of each range it comes from
    another one, and these few rows (one for each range) meet in a join. A null text is the empty text. A null id comes
    after all others. Repeated ids follow one another in the order of a hash (XXH64) of their texts. An empty table gives no rows. Other
    columns of docs are ignored; texts of any length are read whole.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]  # the hash lets rows of one id lie in several ranges
    dealt = base.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    schema = f"doc_id long, part int, kind string, text string, {FIELDS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple | None = None
        empty = (None,) * 6
        for batch in in_parts(batches):
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = signature(shingles(t.encode()))
                if held is None:
                    rows.append((i, part, "first", t, *empty))
                else:
                    rows.append((held[0], part, "row", None, *compared(*held[1:], t, s)))
                held = (i, t, s)
            if rows:
                yield record(rows)
        if held is not None:
            yield record([(held[0], part, "last", held[1], *empty)])

    def record(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * 3, pa.float64(), pa.float64()]
    names = [x.split()[0] for x in schema.split(", ")]
    found = cut(dealt.mapInArrow(run, schema))
    # the first row of the range after each range, cyclically; only range numbers are sorted in one place
    parts = found.where("kind = 'first'").select("part")
    whole = Window.orderBy("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(whole), F.min("part").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    first = found.where("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    ends = found.where("kind = 'last'").select("doc_id", "part", "text").join(after, "part").join(first, "next").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows = [(i, *compared(t, signature(shingles(t.encode())), f, signature(shingles(f.encode())))) for i, t, f in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), [kinds[0], *kinds[4:]], strict=True)], [names[0], *names[4:]])

    out = found.where("kind = 'row'").drop("part", "kind", "text").unionByName(ends.mapInArrow(finish, f"doc_id long, {FIELDS}"))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def crowded_links(index: DataFrame, similarity: float, block: int) -> DataFrame:
    """Edges a, b for bands that many nodes share: index has band, n, node, shingles.

    A band's nodes are dealt into blocks, pairs of blocks are compared on their own, and what comes out is a forest that
    connects the nodes that are alike, not the pairs.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = index.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("band", "node", "shingles", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def forest(pdf: pd.DataFrame) -> pd.DataFrame:
        node, sets = pdf["node"].tolist(), [set(x.tolist()) for x in pdf["shingles"]]
        group, edges = list(range(len(node))), []
        for i, a in enumerate(sets):
            for j in range(i):
                if group[i] != group[j] and (shared := len(a & sets[j])) >= similarity * (len(a) + len(sets[j]) - shared):
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
                    edges.append((node[i], node[j]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("band", "i", "j").applyInPandas(forest, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, similarity: float = 0.8, bands: int = 32, hot: int = 200, block: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id for each row of docs: texts whose five-word shingles have a Jaccard similarity of at least
    ``similarity`` are linked, and class_id is the smallest doc_id reachable.

    Texts with the same shingles are one node, so copies make no pairs. Nodes that share a band of the signature are
    candidates, verified on the shingle sets; bands that more than ``hot`` nodes share are compared in blocks. Null and
    empty texts are all alike. A null id is a row like others, smallest only if there is no other. Repeated rows each
    give a row; an empty table gives none; other columns of docs are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            sets = [np.unique(shingles(t.encode())) for t in batch.column(1).to_pylist()]
            node = [xxhash.xxh3_64_intdigest(h.tobytes()) for h in sets]
            signs = [signature(h).astype(np.int32) for h in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(node, np.uint64).view(np.int64)), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64())), pa.array(signs, pa.list_(pa.int32()))], ["doc_id", "node", "shingles", "signature"]
            )

    rows = cut(base.mapInArrow(run, "doc_id long, node long, shingles array<long>, signature array<int>"))
    least = cut(rows.groupBy("node").agg(F.min("doc_id").alias("least")))
    nodes = rows.select("node", "shingles", "signature").dropDuplicates(["node"])
    width = PERMUTATIONS // bands
    band = F.array(*[F.xxhash64(F.lit(i), F.slice("signature", 1 + i * width, width)) for i in range(bands)])
    index = nodes.select("node", F.explode(band).alias("band"))
    crowded = cut(index.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot))
    some = not crowded.isEmpty()
    cold = index.join(crowded, "band", "left_anti") if some else index
    x, y = cold.alias("x"), cold.alias("y")
    pairs = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("shingles").alias(f"set_{n}"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    alike = shared >= F.lit(similarity) * (F.size("set_a") + F.size("set_b") - shared)
    edges = pairs.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b")
    if some:
        edges = edges.unionByName(crowded_links(index.join(crowded, "band").join(nodes.select("node", "shingles"), "node"), similarity, block))
    roots = components(edges)
    named = least.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    classes = named.join(named.groupBy("root").agg(F.min("least").alias("class_id")), "root").select("node", "class_id")
    return rows.select("doc_id", "node").join(classes, "node").select("doc_id", "class_id")
